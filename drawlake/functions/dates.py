"""Date parsing and formatting.

ANSI mode is on by default in Spark 4, where ``to_date`` raises on bad text;
every parser here uses the ``try_`` form so a bad value becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns the sources publish dates in.
DMY_ABBR = "dd-MMM-yyyy"     # 12-Oct-2021
ISO_DATE = "yyyy-MM-dd"      # 2021-10-12
D_MON_Y = "d MMM yyyy"       # 12 Oct 2021

_WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str | None = None) -> Column:
    """Text to date with an optional pattern; unparsable text gives null."""
    c = _c(c)
    if fmt is None:
        return F.to_date(F.try_to_timestamp(c))
    return F.try_to_date(c, fmt)


def normalize_date(c) -> Column:
    """Generic parse of text/timestamp/date, truncated to the calendar day."""
    c = _c(c)
    return F.to_date(F.coalesce(F.try_to_timestamp(c.cast("string")),
                                F.try_to_timestamp(c.cast("string"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))))


def day_name(c) -> Column:
    """English weekday name without padding (F5); locale-free via ``weekday``."""
    d = _c(c)
    idx = F.weekday(d)  # 0 = Monday
    expr = F.when(idx.isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(_WEEKDAYS):
        expr = expr.when(idx == i, F.lit(name))
    return expr


def mon_date_text(c) -> Column:
    """``YYYY-MON-DD`` with an upper-case month abbreviation."""
    return F.upper(F.date_format(_c(c), "yyyy-MMM-dd"))


def is_weekday(c, name: str | None) -> Column:
    """True when the date falls on ``name`` ('Tuesday', ...); ``None``/'all' keeps all."""
    if name is None or name.lower() == "all":
        return F.lit(True)
    want = name.strip().capitalize()
    if want not in _WEEKDAYS:
        raise ValueError(f"unknown weekday {name!r}")
    return F.weekday(_c(c)) == _WEEKDAYS.index(want)
