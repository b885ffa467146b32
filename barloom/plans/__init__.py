from .features import (  # noqa: F401
    DIRECTION_FEATURES,
    PRICE_FEATURES,
    assemble,
    direction_features,
    price_features,
)
from .report import (  # noqa: F401
    describe,
    leaderboard,
    metric_report,
    naive_predictions,
    predictions,
    suggest,
)
