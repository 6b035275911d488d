"""Scalar column functions (all built-in Spark expressions, codegen-friendly)."""

from drawlake.functions.dates import day_name, is_weekday, mon_date_text, normalize_date, parse_date
from drawlake.functions.text import (
    blank_to_null, clean_text, last_position, money_to_decimal, sigmoid, split_codes,
)

__all__ = ["parse_date", "normalize_date", "day_name", "mon_date_text", "is_weekday", "money_to_decimal", "split_codes",
           "clean_text", "blank_to_null", "sigmoid", "last_position"]
