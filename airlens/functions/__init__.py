"""Column-level building blocks; each returns a ``Column`` and stays inside codegen."""

from airlens.functions.numbers import (
    bucketize, clean_number, first_match, is_number, piecewise, safe_corr, stable_round,
    to_double,
)
from airlens.functions.text import norm_city, norm_country, squeeze
from airlens.functions.times import parse_ts

__all__ = [
    "bucketize", "clean_number", "first_match", "is_number", "norm_city", "norm_country",
    "parse_ts", "piecewise", "safe_corr", "squeeze", "stable_round", "to_double",
]
