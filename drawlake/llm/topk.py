"""Exact top-k inner products by block-at-a-time pruning.

Candidates lie in blocks of neighbouring ids. Each block has a forward index
(its rows as a matrix) and, per term, the largest and smallest component. For
a query the bound of a block is the sum over terms of the larger product with
either, so blocks are scored from the highest bound down until a bound falls
below the k-th best score found so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawlake.llm.common import partitions, prepare, write_and_reread

#: Rows of a block, blocks of a super-block (one unit of work), queries of a group.
BLOCK, SUPER, QUERY_GROUP = 256, 32, 512


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double; null for a vector that is null or
    holds a null or non-finite component."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(x, lambda v: F.floor(v * float(scale)).cast("long")))


def _matrix(ids: list, vectors: list, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the zero-padded matrix of vectors that may differ in length."""
    width = max([dims or 0, *map(len, vectors)])
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return np.array(ids, dtype=np.int64), out


def _packed(rows: Iterator[pa.RecordBatch], at_most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Consecutive rows (id, vector) as matrices of ``at_most`` rows."""
    ids, vectors = [], []
    for batch in rows:
        for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            ids.append(i)
            vectors.append(v)
            if len(ids) == at_most:
                yield _matrix(ids, vectors)
                ids, vectors = [], []
    if ids:
        yield _matrix(ids, vectors)


def _pad(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def search_super_block(q_ids, q, floor, ids, m, k):
    """The top k of one super-block for each query: arrays query, candidate, score.

    ``floor`` holds, per query, a score that k candidates are already known to
    reach (or the smallest integer); nothing below it is returned.
    """
    width = max(q.shape[1], m.shape[1])
    q, m = _pad(q, width), _pad(m, width)
    top = float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * max(width, 1)
    if top < 2 ** 53:  # then every product and sum is exact in floating point, which is faster
        q, m = q.astype(np.float64), m.astype(np.float64)
    blocks = [slice(a, a + BLOCK) for a in range(0, len(ids), BLOCK)]
    high = np.stack([m[b].max(axis=0) for b in blocks])
    low = np.stack([m[b].min(axis=0) for b in blocks])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    out = []
    for j in range(len(q_ids)):
        kth, best_id, best = int(floor[j]), np.empty(0, np.int64), np.empty(0, np.int64)
        for b in order[j]:
            if bound[j, b] < kth:
                break
            score, cand = (m[blocks[b]] @ q[j]).astype(np.int64), ids[blocks[b]]
            good = (score >= kth) & (cand != q_ids[j])
            best, best_id = np.concatenate([best, score[good]]), np.concatenate([best_id, cand[good]])
            if len(best) >= k:
                first = np.lexsort((best_id, -best))[:k]
                best, best_id = best[first], best_id[first]
                kth = max(kth, int(best[-1]))
        out.append((np.full(len(best), q_ids[j]), best_id, best))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


_GROUP = "part int, ids binary, m binary, dims int"


def _grouped(at_most: int, parts: int):
    """Rows (id, vector) to rows of ``_GROUP``: matrices of ``at_most`` rows, dealt over ``parts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId()
        for k, (ids, m) in enumerate(_packed(batches, at_most)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([(first + k) % parts], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([m.tobytes()], pa.binary()), pa.array([m.shape[1]], pa.int32())],
                names=["part", "ids", "m", "dims"])
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products of every query.

    Both inputs have ``id`` (long) and ``vector`` (array<long>); other columns
    are ignored. The query's own id is no candidate; ties go to the smaller id;
    fewer candidates than k are all returned. Vectors of different lengths are
    padded with zeros. Rows with a null id or vector take no part. Scores
    beyond 63 bits are undefined. Repeated candidate rows are candidates of
    their own; a repeated query id is searched once. Empty input: empty result.

    Every query meets every super-block, as blocks; only the queries' matrices
    are replicated, once per part. A first pass over one part gives each
    query a score that k candidates reach; the second skips blocks below it.
    """
    spark = vectors.sparkSession
    prepare(spark)
    parts = partitions(spark)
    used = [F.col("id").cast("long").alias("id"), F.col("vector").cast("array<long>").alias("vector")]
    rows = vectors.select(*used).where("id is not null and vector is not null")
    asked = queries.select(*used).where("id is not null and vector is not null").dropDuplicates(["id"])
    # The hash only splits an id that very many rows share.
    supers = write_and_reread(rows.repartitionByRange(parts, "id", F.xxhash64("vector")).sortWithinPartitions("id")
                              .mapInArrow(_grouped(BLOCK * SUPER, parts), _GROUP), "supers")
    groups = write_and_reread(asked.mapInArrow(_grouped(QUERY_GROUP, parts), _GROUP)
                              .withColumn("q", F.monotonically_increasing_id()), "queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, ids = (np.frombuffer(r[c], np.int64) for c in ("q_ids", "ids"))
                floors = dict(r["floors"] or ())
                floor = [floors.get(i, np.iinfo(np.int64).min) for i in q_ids.tolist()]
                found = search_super_block(q_ids, np.frombuffer(r["q_m"], np.int64).reshape(len(q_ids), r["q_dims"]), floor,
                                           ids, np.frombuffer(r["m"], np.int64).reshape(len(ids), r["dims"]), k)
                yield pa.RecordBatch.from_arrays([pa.array([r["q"]] * len(found[0]), pa.int64()), *map(pa.array, found)],
                                                 names=["q", "query_id", "vec_id", "score"])

    def scored(asking: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        asking = asking.select("part", "q", F.col("ids").alias("q_ids"), F.col("m").alias("q_m"),
                               F.col("dims").alias("q_dims"), "floors")
        return (asking.join(supers, "part").mapInArrow(search, "q long, query_id long, vec_id long, score long")
                .withColumn("rank", rank).where(F.col("rank") <= k))

    no_floor = F.lit(None).cast("map<bigint,bigint>")
    floors = (scored(groups.withColumn("floors", no_floor)).where(F.col("rank") == k).groupBy("q")
              .agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("floors")))  # at most a group
    everywhere = (groups.join(write_and_reread(floors, "floors"), "q", "left")
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    return scored(everywhere).select("query_id", "rank", "vec_id", "score")
