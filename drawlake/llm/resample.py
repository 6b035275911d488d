"""Importance resampling towards a target distribution, drawn by exact global ranks.

Hashed one- and two-word features are counted over the raw documents and over
the target texts; a bucket's gain is the floored log ratio of both, a
document's weight the floored mean of its features' gains. Adding a Gumbel
variate that a hash of the id gives and taking the highest scores is a draw
without replacement in proportion to the weights.

Ranks come from parallel sorting by regular sampling: every task sorts its run
and gives every so-many-th row as a sample, the sorted samples give regular
splitters, the runs' segments between splitters are exchanged and merged, and
prefix counts of the segments turn places into ranks.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import id_and_text, partitions, prepare, write_and_reread
from drawlake.llm.plain_words import plain_words

#: A worker's memo of words starts afresh beyond this number.
MEMO_WORDS = 400_000
#: Texts go through the arrays in blocks of about so many bytes.
BLOCK_BYTES = 4_000_000
#: Longest word whose pairs are joined by tables; pairs that end in a longer one are hashed as they are.
TABLE_LENGTH = 64


def _byte_table() -> np.ndarray:
    """CRC-32's table: the remainder of each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _shift_tables(longest: int) -> np.ndarray:
    """``[length, byte of the CRC, its value]``: what a CRC becomes after so many zero bytes.

    A CRC is linear over bits, so crc(a + b) = shifted(crc(a), len(b)) ^ crc(b).
    """
    step, out = _byte_table(), np.empty((longest + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(longest):
        out[n + 1] = step[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


_TABLES: dict[str, object] = {}


class _Codes(dict):
    """Word to its length and CRC-32 in one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        code = self[word] = len(word) << 32 | zlib.crc32(word)
        return code


def _worker_state() -> tuple[_Codes, np.ndarray, np.ndarray]:
    """Memo and tables, made once per worker (a module's function is not copied with a task)."""
    if not _TABLES:
        _TABLES.update(byte=_byte_table(), shift=_shift_tables(TABLE_LENGTH).reshape(-1), codes=_Codes())
    return _TABLES["codes"], _TABLES["byte"], _TABLES["shift"]


def feature_hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every one- and two-word feature of texts given as words, text by text,
    and the number of features of each text."""
    codes, byte, shift = _worker_state()
    counts = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    words = [w for t in texts for w in t]
    packed = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
    n_features = np.maximum(2 * counts - 1, 0)
    if not words:
        return np.empty(0, np.uint32), n_features
    crc, length = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
    # The CRC of the first word and a space, then shifted past the second word.
    spaced = ~crc[:-1]
    spaced = ~(byte[(spaced ^ 32) & 0xFF] ^ (spaced >> 8))
    short = np.minimum(length[1:], TABLE_LENGTH) * 1024
    pair = crc[1:].copy()
    for k in range(4):
        pair ^= shift[short + 256 * k + ((spaced >> (8 * k)) & 0xFF)]
    for k in np.flatnonzero(length[1:] > TABLE_LENGTH).tolist():
        pair[k] = zlib.crc32(words[k] + b" " + words[k + 1])
    # Place words and pairs alternately; the pair after a text's last word spans two texts.
    both = np.empty(2 * len(words) - 1, dtype=np.uint32)
    both[::2], both[1::2] = crc, pair
    ends = np.cumsum(counts)[:-1]
    ends = ends[(ends > 0) & (ends < len(words))]
    return np.delete(both, np.unique(2 * ends - 1)), n_features


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows of the given columns and the texts' words, in blocks of about ``BLOCK_BYTES`` bytes."""
    kept, texts, size = [], [], 0
    for batch in batches:
        for *row, text in zip(*(batch.column(c).to_pylist() for c in [*columns, "text"]), strict=True):
            kept.append(row)
            texts.append(plain_words(text))
            size += len(text)
            if size >= BLOCK_BYTES or len(kept) >= 8192:
                yield kept, texts
                kept, texts, size = [], [], 0
    if kept:
        yield kept, texts


def feature_counts(texts: DataFrame, buckets: int, text_col: str = "text") -> np.ndarray:
    """Number of features in each bucket over all texts (one row per bucket reaches the driver)."""
    prepare(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, words in _blocks(batches, []):
            total += np.bincount(feature_hashes(words)[0] % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                                         names=["bucket", "n"])

    rows = (texts.select(F.col(text_col).cast("binary").alias("text")).where("text is not null")
            .mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of target against raw share in each bucket, smoothed by one."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    k = len(raw)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def noise(doc_id, seed: int) -> int:
    """floor(1000 * Gumbel variate) of a hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, n_features, weight, score`` of every whole document; ``row`` is unique."""
    spark = docs.sparkSession
    prepare(spark)
    sent, buckets = spark.sparkContext.broadcast(gains), len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 33
        for kept, words in _blocks(batches, ["doc_id"]):
            hashes, n = feature_hashes(words)
            sums = np.concatenate([[0], np.cumsum(sent.value[hashes % buckets])])
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            ids = [r[0] for r in kept]
            score = weight + np.array([noise(i, seed) for i in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64()),
                 pa.array(list(map(len, words)), pa.int64()), *map(pa.array, (n, weight, score))],
                names=["row", "doc_id", "n_words", "n_features", "weight", "score"])
            row += len(ids)

    return (id_and_text(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
            .mapInArrow(run, "row long, doc_id long, n_words long, n_features long, weight long, score long"))


_SORT = ["key", "tie", "row"]


def _sorted_run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """One task's rows (columns key, tie, row) in order."""
    cols = [[], [], []]
    for batch in batches:
        for k, c in enumerate(_SORT):
            cols[k].append(batch.column(c).to_numpy())
    run = np.stack([np.concatenate(c) if c else np.empty(0, np.int64) for c in cols], axis=1)
    return run[np.lexsort((run[:, 2], run[:, 1], run[:, 0]))]


def _below(run: np.ndarray, splitter: tuple[int, int, int]) -> int:
    """Number of rows of a sorted run that come before the splitter."""
    lo, hi = 0, len(run)
    for k in range(3):  # narrow down to the rows that are equal in the columns so far
        a = lo + int(np.searchsorted(run[lo:hi, k], splitter[k], side="left"))
        b = lo + int(np.searchsorted(run[lo:hi, k], splitter[k], side="right"))
        lo, hi = a, b
        if lo == hi:
            break
    return lo


#: Segments are as many as shuffle partitions and hold about so many rows, up to the largest number of segments.
SEGMENT_ROWS, MOST_SEGMENTS, OVERSAMPLE = 65_536, 16_384, 16


def rank_rows(rows: DataFrame, first: int | None = None) -> DataFrame:
    """``row, rank``: place (from 1) of each row in the order of ``key``, ``tie``, ``row``.

    The three columns are longs without nulls and ``row`` is unique, so equal
    keys, however many, never have to share a segment. Input rows must be
    pinned (a written table), as three scans have to see the same ones.

    * Each task sorts its rows (one run) and gives every m-th of them, starting
      from a hashed place, with m chosen so that about ``OVERSAMPLE`` rows of
      24 bytes for each segment reach the driver.
    * Every ``OVERSAMPLE``-th of the sorted samples is a splitter.
    * Each run sends its part of every segment as one block; a segment's
      blocks are merged (a stable sort, which merges sorted runs) and numbered
      from the prefix count of the segments before it.

    ``first`` asks for the first places only: segments that begin beyond them
    are not exchanged. Empty input: empty result.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.select(*_SORT)
    total = rows.count()
    first = total if first is None else first
    segments = min(max(partitions(spark), -(-total // SEGMENT_ROWS)), MOST_SEGMENTS)
    every = max(1, total // (OVERSAMPLE * segments))

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _sorted_run(batches)
        run = run[zlib.crc32(run[:1].tobytes()) % every::every]
        yield pa.RecordBatch.from_arrays([pa.array(run[:, k].copy()) for k in range(3)], names=_SORT)

    schema = ", ".join(f"{c} long" for c in _SORT)
    given = sorted(tuple(r) for r in rows.mapInArrow(give, schema).collect())
    splitters = spark.sparkContext.broadcast(given[OVERSAMPLE - 1::OVERSAMPLE])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _sorted_run(batches)
        at = [0, *(_below(run, s) for s in splitters.value), len(run)]
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            if b > a:
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([b - a], pa.int64()),
                                                  pa.array([run[a:b].tobytes()], pa.binary())], names=["segment", "n", "block"])

    # The counts and, later, the blocks come from two scans of the same pinned rows.
    blocks = rows.mapInArrow(cut, "segment int, n long, block binary")
    count = {r[0]: r[1] for r in blocks.groupBy("segment").agg(F.sum("n")).collect()}  # one row per segment
    places = np.concatenate([[0], np.cumsum([count.get(k, 0) for k in range(len(splitters.value) + 1)])])
    wanted = int(np.searchsorted(places[:-1], first))

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        run = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 3) for b in pdf["block"]])
        run = run[np.lexsort((run[:, 2], run[:, 1], run[:, 0]))]
        rank = places[int(key[0])] + 1 + np.arange(len(run))
        return pd.DataFrame({"row": run[:, 2], "rank": rank})[rank <= first]

    return blocks.where(F.col("segment") < wanted).groupBy("segment").applyInPandas(merge, "row long, rank long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, least_words: int = 20,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every whole document, one row per input row.

    Of the N documents with at least ``least_words`` words, the floor of
    ``percent`` hundredths with the highest scores are drawn; ``rank`` is their
    place (ties: the smaller ``doc_id``, a null id last, then any order among
    rows that are equal in both), and null for the others.

    Null or empty text: no features, weight 0. Null ids share one variate, and
    so do repeated ids. Without target texts every gain compares with an even
    spread over the buckets. Extra columns are ignored. Empty input: empty result.
    """
    raw = feature_counts(docs, buckets, text_col)
    gains = bucket_gains(raw, feature_counts(target, buckets, target_text_col))
    scored = write_and_reread(weigh(docs, gains, seed, id_col, text_col), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    last = F.lit(2 ** 63 - 1)
    ranks = rank_rows(able.select((-F.col("score")).alias("key"), F.coalesce("doc_id", last).alias("tie"), "row"),
                      percent * able.count() // 100)
    return scored.join(ranks, "row", "left").drop("row")
