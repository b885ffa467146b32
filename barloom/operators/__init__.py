from .clean import clean, newest_per_key, only_symbols, to_bars  # noqa: F401
from .profile import bins2d, corr_pairs, density, histogram, profile, row_counts  # noqa: F401
from .score import accuracy, auc, mse, rmse  # noqa: F401
from .sequence import sequence_features  # noqa: F401
from .split import (  # noqa: F401
    except_rows,
    hash_sample,
    hash_split,
    time_split,
    time_split_by_date,
)
from .trailing import (  # noqa: F401
    direction_target,
    mean_deviation,
    relative_volume,
    trailing_avg,
)
