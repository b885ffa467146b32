"""Column names, schemas and session settings shared by every module."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "Stock"
TIME = "Date"
DAY = 86_400  # seconds

PRICES = ["Open", "High", "Low", "Close", "AdjClose"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField("Stock", T.StringType()),
        T.StructField("Date", T.TimestampType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("AdjClose", T.DoubleType()),
        T.StructField("Volume", T.DoubleType()),
    ]
)

# Column order and date pattern of the raw daily-bar CSV files,
# the symbols studied, and the company names shown for five of them.
CSV_COLUMNS = ["Date", "Low", "Open", "Volume", "High", "Close", "Adj Close"]
CSV_DATE_FORMAT = "d-M-yyyy"
TOP_SYMBOLS = ["GT", "TXN", "DIOD", "MSEX", "VLGEA", "KLIC", "OTTR", "SGC", "PHI", "APOG"]
COMPANY_NAMES = {
    "GT": "Goodyear Tire & Rubber Co",
    "KLIC": "Kulicke and Soffa Industries Inc.",
    "OTTR": "Otter Tail Corporation",
    "SGC": "Superior Group of Companies Inc",
    "PHI": "PLDT Inc ADR",
}


def epoch_seconds(time: str = TIME) -> Column:
    """Whole seconds since 1970; TIMESTAMP_NTZ and TIMESTAMP both work."""
    return F.col(time).cast("timestamp").cast("long")


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the plans rely on; cluster sizing is left to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def company_names(spark: SparkSession) -> DataFrame:
    """Symbol dimension ``(Stock, description)``."""
    return spark.createDataFrame(list(COMPANY_NAMES.items()), "Stock string, description string")


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session (``spark.checkpoint.dir``).

    Only a local session may fall back to a temporary folder: on a cluster the
    folder has to be one that every executor can reach.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="barloom-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    With ``partition_by`` a later equality filter on that column reads only its
    own files, which is what a fit per symbol needs. Rows are then gathered by value, a
    large value over several tasks (AQE splits it), so that each has few files. The
    table stays in the checkpoint folder and goes when that folder is emptied.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if partition_by:
        gathered = df.hint("rebalance", F.col(partition_by))
        gathered.write.partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
