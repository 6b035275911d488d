"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.session import ensure_checkpoint_dir, ship_package, write_and_reread

#: Fixed value: one word is a run of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

__all__ = ["WORD_PATTERN", "SPACE_PATTERN", "broadcast_file", "id_and_text", "words_of",
           "partitions", "table", "prepare", "kept_by_worker", "forget_kept", "write_and_reread"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder registered and the package available to Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two needed columns, under fixed names; a null text counts as empty.

    Selecting first means extra columns, whatever their names, never meet an
    operator's own columns.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def words_of(text: Column) -> Column:
    """Array of the text's words (native)."""
    return F.array_remove(F.split(text, SPACE_PATTERN), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_file(spark: SparkSession, path: str, max_bytes: int = 64 << 20):
    """Broadcast a vocabulary file's bytes, after checking its size."""
    if os.path.getsize(path) > max_bytes:
        raise ValueError(f"{path} is larger than the {max_bytes} bytes allowed for a broadcast vocabulary")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_KEPT: dict[Hashable, object] = {}


def kept_by_worker(key: Hashable, make: Callable[[], object]) -> object:
    """``make()``, which a Python worker keeps from task to task until another key is asked for.

    All operators share this one place, so a worker that serves one after
    another holds the largest of their tables and not the sum of them. (A
    module's function is not copied with a task, so the place outlives it.)
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget_kept() -> None:
    """Free what an earlier operator's tasks left in this worker."""
    _KEPT.clear()
