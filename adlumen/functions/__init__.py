"""Column-expression helpers (no UDFs)."""

from adlumen.functions.geohash import geohash
from adlumen.functions.strings import (
    is_blank,
    not_blank,
    split_drop_trailing,
    split_keep_trailing,
    to_double_or_zero,
    to_int_or_zero,
)

__all__ = [
    "geohash",
    "is_blank",
    "not_blank",
    "split_drop_trailing",
    "split_keep_trailing",
    "to_double_or_zero",
    "to_int_or_zero",
]
