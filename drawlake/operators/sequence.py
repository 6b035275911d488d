"""Global order without a single-task window (O46) and trailing-window scatter.

``Window.orderBy`` with no partition sends every row to one task. The global
sequence here is range-partitioned on the full ordering key, numbered inside
each partition, and offset by a prefix sum over the per-partition counts.

Range bounds come from sampling, and the sample depends on the row order the
upstream shuffle delivers, so two evaluations of the same plan can split the
rows differently. The numbered partitions are therefore written once as
parquet in the shared checkpoint folder (``spark.checkpoint.dir``) before
counts and offsets are read from them; a lost executor then re-reads that
copy instead of re-deriving a different split, and later scans read only
the columns they need.

The per-partition offsets then come from one count over that copy: a table
with one row per partition, so it is bounded by the partition count and is
carried into the plan as a literal array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.session import write_and_reread

_LOCAL_BITS = 33  # monotonically_increasing_id packs (partition << 33) + row


def global_sequence(df: DataFrame, order_cols: Sequence[str | Column],
                    seq_col: str = "seq", num_partitions: int | None = None) -> DataFrame:
    """Add a dense 1..N sequence number following ``order_cols`` ascending.

    ``order_cols`` should be a total order (add tie-break columns); with ties
    the numbers are still a permutation of 1..N but tied rows may swap.
    Range partitioning samples the key, so a hot leading value (one date with a
    third of the rows) is still split across partitions by the later columns.

    After the checkpoint, the per-partition counts (one row per partition,
    a bounded table) are turned into an offset array literal indexed by
    partition id, so ``seq`` is a plain projection over the checkpointed rows:
    downstream plans carry no join.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_rowid", F.monotonically_increasing_id()))
    tagged = write_and_reread(tagged, "sequence")
    part = F.shiftright("_rowid", _LOCAL_BITS)
    local = F.col("_rowid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = dict((r[0], r[1]) for r in tagged.groupBy(part.alias("p")).count().collect())
    # Offsets indexed by partition id (ids are dense 0..n-1; empty ones add 0):
    # an array literal gives an O(1) lookup per row.
    offsets, acc = [], 0
    for p in range(max(counts) + 1 if counts else 0):
        offsets.append(acc)
        acc += counts.get(p, 0)
    if offsets:
        offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), (part + 1).cast("int"))
    else:
        offset = F.lit(0).cast("long")
    return (tagged.withColumn(seq_col, offset + local + F.lit(1))
                  .drop("_rowid"))


def scatter(df: DataFrame, seq_col: str, k_from: int, k_to: int,
            target_col: str = "t", k_col: str = "k",
            min_target: int | Column | None = None,
            max_target: int | Column | None = None) -> DataFrame:
    """Each row contributes to the rows ``seq + k`` for k in ``k_from..k_to``.

    A trailing window of w rows over a gap-free sequence equals every row
    sending itself to its next w rows; a later ``groupBy(target)`` then does
    the window work with partial aggregation and no global sort. Each target
    receives at most (k_to - k_from + 1) copies per source row, so no key can
    grow with the data.
    """
    out = (df.select("*", F.explode(F.sequence(F.lit(k_from), F.lit(k_to))).alias(k_col))
             .withColumn(target_col, F.col(seq_col) + F.col(k_col)))
    if min_target is not None:
        out = out.where(F.col(target_col) >= min_target)
    if max_target is not None:
        out = out.where(F.col(target_col) <= max_target)
    return out


def chunk_overlap(df: DataFrame, seq_col: str, window: int, chunk: int,
                  chunk_col: str = "_chunk", home_col: str = "_home") -> DataFrame:
    """Copy each row to every chunk whose rows it can precede within ``window``.

    Rows are assigned to chunk ``seq div chunk``; a row is also copied to the
    chunks of ``seq + 1 .. seq + window``. Partitioning a window by the chunk
    then sees every row's full trailing history; keep rows where
    ``home_col`` is true. About ``window / chunk`` extra copies per row.
    """
    first = F.floor(F.col(seq_col) / chunk)
    last = F.floor((F.col(seq_col) + window) / chunk)
    return (df.select("*", F.explode(F.sequence(first, last)).alias(chunk_col))
              .withColumn(home_col, F.col(chunk_col) == first))
