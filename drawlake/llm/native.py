"""Array helpers in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body (or a lambda in it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Exclusive running totals of a short array of longs."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(values, start, lambda acc, v: F.struct(
        step(acc["total"], v).alias("total"), F.concat(acc["out"], F.array(acc["total"])).alias("out")),
        lambda acc: acc["out"])


def running(values: Column, step: Callable[[Column, Column], Column] | None = None, chunk: int = 256) -> Column:
    """Exclusive running totals (from 0) of an array of longs, by ``step`` (default: sum).

    Appending to an array copies it, so long arrays go in chunks: running
    totals inside each, offset by the running totals of the chunks.
    """
    step = step or (lambda a, b: a + b)
    zero = F.lit(0).cast("long")

    def by_chunks(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / chunk).cast("int")),
                            lambda c: F.slice(v, c * chunk + 1, F.lit(chunk)))
        return let(parts, lambda ps: let(
            _running(F.transform(ps, lambda p: F.aggregate(p, zero, step)), step),
            lambda starts: F.flatten(F.transform(ps, lambda p, k: F.transform(
                _running(p, step), lambda x: step(F.element_at(starts, k + 1), x))))))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<long>"))
               .when(F.size(v) <= chunk, _running(v, step)).otherwise(by_chunks(v)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the pattern's leftmost non-overlapping matches.

    Positions count code points, end exclusive. The texts between matches and
    the matches alternate, so running lengths of both give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    between = F.split(text, pattern, -1)

    def place(f: Column) -> Column:
        sizes = F.transform(f, lambda m: F.length(m).cast("long"))
        gaps = F.transform(F.slice(between, F.lit(1), F.size(f)), lambda g: F.length(g).cast("long"))
        return let(gaps, lambda g: let(running(F.zip_with(g, sizes, lambda a, b: a + b)), lambda at: F.transform(
            f, lambda m, k: F.struct(
                (F.element_at(at, k + 1) + F.element_at(g, k + 1)).alias("start"),
                (F.element_at(at, k + 1) + F.element_at(g, k + 1) + F.length(m)).alias("end"),
                m.alias("value")))))

    return let(found, place)
