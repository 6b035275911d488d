"""Incremental upsert of newly arriving draw files (re-aimed scheduled loads).

Files landing in a folder are read with ``readStream`` under a declared
schema; ``trigger(availableNow=True)`` processes everything new and stops,
which is what a scheduled load does, with the streaming checkpoint
remembering which files were already merged. Each micro-batch goes through
the same snapshot merge as the batch path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from drawlake.sources.snapshots import latest_snapshot_id, merge_into, read_latest

__all__ = ["latest_snapshot_id", "merge_batch", "read_latest", "start_incremental_upsert"]


def merge_batch(table_path: str, keys: Sequence[str], prepare: Callable[[DataFrame], DataFrame] | None = None,
                order_col: str | None = None):
    """``foreachBatch`` function: merge the batch into the snapshot table.

    The commit log remembers the query's id (kept in its checkpoint) and the
    batch, so a batch tried again is merged once, and a query with a new
    checkpoint, which counts its batches from 0 again, still adds snapshots
    after the existing ones.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        merge_into(table_path, prepare(batch) if prepare else batch, keys, order_col=order_col,
                   writer=(query, batch_id))
    return run


def start_incremental_upsert(spark: SparkSession, source_dir: str, schema: T.StructType,
                             table_path: str, checkpoint_location: str, keys: Sequence[str],
                             fmt: str = "csv", options: dict | None = None,
                             prepare: Callable[[DataFrame], DataFrame] | None = None,
                             order_col: str | None = None) -> StreamingQuery:
    """Start an available-now stream merging new files of ``source_dir`` into ``table_path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)
    return (stream.writeStream.foreachBatch(merge_batch(table_path, keys, prepare, order_col))
                  .option("checkpointLocation", checkpoint_location)
                  .trigger(availableNow=True).start())
