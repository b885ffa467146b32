from .bars import file_headers, normalise, read_bars, write_bars  # noqa: F401
from .keyed import lookup, put_bars, upsert_bars  # noqa: F401
