"""Contiguous shards of near-equal bytes by global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from drawlake.llm.common import partitions, prepare, write_and_reread


def shard_by_bytes(rows: DataFrame, n_shards: int, size_col: str, order_cols: list[str]) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 inside a shard) to ``rows``.

    Rows are put in the order of ``order_cols`` by a range partitioning, which
    also splits equal leading keys by the later ones. Each partition sums its
    own sizes; the totals of all partitions (one row each, so as many as there
    are partitions) become every partition's starting offset, and a row's shard
    follows from where the middle of its bytes falls among ``n_shards`` equal
    targets. Shards are therefore contiguous in the order and differ from the
    target by less than one row's size at either end.

    Range bounds come from sampling, so the partitions are written once to the
    shared folder before they are summed; lost executors cannot move a bound.
    Sizes must not be null or negative (raises). All sizes zero: one shard.
    Empty input: empty output.
    """
    spark = rows.sparkSession
    prepare(spark)
    part, local, before = "__part", "__local", "__before"
    schema = StructType([*rows.schema.fields, *(StructField(c, LongType()) for c in (part, local, before))])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid, count, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if batch.column(size_col).null_count:
                raise ValueError("a size is null")
            size = batch.column(size_col).to_numpy(False).astype(np.int64)
            if (size < 0).any():
                raise ValueError("a size is negative")
            ends = total + np.cumsum(size)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, pid, np.int64)), pa.array(np.arange(count, count + n)),
                 pa.array(ends - size)], names=[*batch.schema.names, part, local, before])
            if n:
                count, total = count + n, int(ends[-1])

    ordered = rows.repartitionByRange(partitions(spark), *order_cols).sortWithinPartitions(*order_cols)
    summed = write_and_reread(ordered.mapInArrow(sums, schema), "shards")
    totals = {r[part]: (r["n"], r["size"]) for r in
              summed.groupBy(part).agg(F.count("*").alias("n"), F.sum(size_col).alias("size")).collect()}
    if not totals:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    rows_before, bytes_before, seen, size = [], [], 0, 0
    for pid in range(max(totals) + 1):
        n, own = totals.get(pid, (0, 0))
        rows_before.append(seen)
        bytes_before.append(size)
        seen, size = seen + n, size + own

    def offset(values: list[int]):
        return F.element_at(F.array(*map(F.lit, values)).cast("array<long>"), (F.col(part) + 1).cast("int"))

    placed = summed.withColumns({before: F.col(before) + offset(bytes_before),
                                 local: F.col(local) + offset(rows_before)})
    middle = (F.col(before).cast("decimal(38,0)") * 2 + F.col(size_col)) * n_shards
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1),
                                                F.floor(middle / F.lit(2 * max(size, 1)).cast("decimal(38,0)")).cast("int")))
    first = {r["shard"]: r["at"] for r in placed.groupBy("shard").agg(F.min(local).alias("at")).collect()}
    starts = F.array(*(F.lit(first.get(k, 0)) for k in range(n_shards))).cast("array<long>")
    return (placed.withColumn("slot", F.col(local) - F.element_at(starts, F.col("shard") + 1))
            .select(*rows.columns, "shard", "slot"))


def document_shards(docs: DataFrame, n_shards: int, overhead: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, one row per input row, by :func:`shard_by_bytes`.

    ``size``: the text's UTF-8 bytes (null: none) plus ``overhead``. Documents
    lie in the order of ``doc_id`` (null first), then checksum and size, so
    repeated ids cannot pile up in one partition; rows equal in all three are
    interchangeable. Texts are read once and not shuffled. The checksum of a
    null text is that of no bytes (0).
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # The last column only spreads rows that are equal in everything reported.
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.length(raw) + overhead).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32")).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    return shard_by_bytes(rows, n_shards, "size", ["doc_id", "text_crc32", "size", "spread"]).drop("spread")
