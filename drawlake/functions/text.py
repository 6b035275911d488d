"""Text and number helpers: clean, blank to null, money, code lists, sigmoid, last position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The whole text of an amount: an optional currency sign, digits (plain or in groups of three), decimals.
MONEY = r"^\s*[£€$]?\s*([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, lower: bool = True) -> Column:
    """Trim, and lower-case unless told otherwise (F8)."""
    t = F.trim(_c(c))
    return F.lower(t) if lower else t


def blank_to_null(c) -> Column:
    """Empty or blank text to null."""
    c = _c(c)
    return F.when(F.trim(c) != "", c)


def sigmoid(c) -> Column:
    """Logistic function of a logit column."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def last_position(arr, n) -> Column:
    """1-based position of the last ``n`` in ``arr``; 0 when absent."""
    a = _c(arr)
    back = F.array_position(F.reverse(a), n)
    return F.when(back == 0, F.lit(0).cast("long")).otherwise(F.size(a) - back + 1)


def money_to_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """``£14,773,000`` to a decimal; any text that is not wholly an amount gives null."""
    text = _c(c).cast("string")
    digits = F.regexp_replace(text, r"[^0-9.]", "")
    return F.when(text.rlike(MONEY), digits.try_cast(f"decimal({precision},{scale})"))


def split_codes(c, sep: str = ",") -> Column:
    """Comma-joined code cell to a trimmed array of non-empty codes."""
    parts = F.split(_c(c), sep)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")
