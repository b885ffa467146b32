from .scalar import (  # noqa: F401
    date_parts,
    hash_unit,
    parse_date,
    spreads,
    typical_price,
    with_sec,
)
