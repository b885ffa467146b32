"""Price-bar analytics as Spark DataFrame plans, all symbols in one job."""
