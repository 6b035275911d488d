"""Near-duplicate detection: universal hash minima, banding, exact verification, components.

The unit of work is a *class*: all documents with the same shingle set. Only one
member of a class is hashed into bands and compared, so copies never form pairs.

Links are found in two rounds that together lose none of the banding's candidates.

1. Every class of a band bucket is compared with a few centres of the bucket,
   and what is linked is joined into components. Most buckets then lie inside
   one component and need nothing more.
2. In the buckets that still hold several components, every class outside the
   bucket's main component is compared with all classes of other components by
   signature and by a sample of the sets (small sets: the whole set), block of
   rows by block of rows inside tasks. What may reach the threshold and was not
   checked before is checked on full sets.

The first round is linear in the classes. The second compares signatures of all
pairs of different components in one bucket, and emits only likely links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import forget_kept, id_and_text, prepare, write_and_reread

#: 40 bands of 5 minima: a pair at similarity 0.8 shares no band with probability (1 - 0.8^5)^40 = 1.2e-7.
BANDS, ROWS = 40, 5
#: Centres of a bucket in the first round.
CENTRES = 3
#: Rows of one bucket compared at a time in the later rounds.
BLOCK = 256
#: Shingles of a set up to which its sample is the whole set.
SAMPLE = 256
#: Word hashes remembered per task.
MEMO_WORDS = 500_000
#: Shingles hashed at a time (bounds the memory of one long document).
CHUNK = 512


def _universal(n: int, seed: int = 20_011) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of n hash functions x -> (a x + b mod 2^64) >> 32, a odd (multiply-add-shift)."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 1 << 64, n, dtype=np.uint64)


def shingle_hashes(text: bytes, size: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``size``-word shingles.

    A-Z are lower-cased, words end at ASCII white space. Fewer words than
    ``size``: the whole sequence is the only shingle; no word: empty.
    """
    import xxhash
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    for w in words:
        if w not in memo:
            memo[w] = digest(w)
    h = np.array([memo[w] for w in words], dtype=np.uint64)
    n = min(size, len(h))
    mixed = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        mixed = (mixed ^ h[k:len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The 200 minima of one set, each cut to its lower 16 bits of the upper word."""
    low = shingles & np.uint64(0xFFFFFFFF)
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(low), CHUNK):
        h = a[:, None] * low[None, at:at + CHUNK]
        h += b[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u2")


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, row_hash, n_shingles, set_key, signature`` per row of ``doc_id, text``.

    ``set_key`` (128 bits) is equal for equal shingle sets and null for a text
    without words; ``row_hash`` identifies the text itself.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        import xxhash
        a, b = _universal(BANDS * ROWS)
        memo: dict[bytes, int] = {}
        done: dict[bytes, bytes] = {}
        for batch in batches:
            n, keys, sigs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                if len(done) > 20_000:
                    done.clear()
                s = shingle_hashes(text, size, memo)
                n.append(len(s))
                if len(s):
                    key = xxhash.xxh3_128_digest(s.tobytes())
                    if key not in done:
                        done[key] = _minima(s, a, b).tobytes()
                    keys.append(key)
                    sigs.append(done[key])
                else:
                    keys.append(None)
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(n, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "row_hash", "n_shingles", "set_key", "signature"])

    return (docs.withColumn("row_hash", F.md5(F.col("text").cast("binary")))
            .select("doc_id", "row_hash", "text")
            .mapInArrow(sign, "doc_id long, row_hash string, n_shingles long, set_key binary, signature binary"))


def _band_rows(classes: DataFrame) -> DataFrame:
    """One row (band, bucket, node) per class and band."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda k: F.xxhash64(k, F.substring("signature", k * width + 1, F.lit(width))))
    return classes.select("node", F.posexplode(keys).alias("band", "bucket"))


def _agreement(x: pd.Series, y: pd.Series) -> np.ndarray:
    n = BANDS * ROWS
    left, right = (np.frombuffer(b"".join(s), "<u2").reshape(-1, n) for s in (x, y))
    return (left == right).sum(axis=1)


def _least_agreement(percent: int) -> int:
    """Matching minima below which a pair is not worth an exact check: 5.5 standard
    deviations under the expected number at the threshold (odds of missing: 2e-8)."""
    n, p = BANDS * ROWS, percent / 100
    return max(0, int(n * p - 5.5 * (n * p * (1 - p)) ** 0.5))


def _class_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``node, shingles``: the full sets of the given classes, from the text of one member each."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        import xxhash
        memo: dict[bytes, int] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                own, out = [], []
                for node, key, text in zip(part.column("node").to_pylist(), part.column("set_key").to_pylist(),
                                           part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                    s = shingle_hashes(text, size, memo)
                    if xxhash.xxh3_128_digest(s.tobytes()) == key:
                        own.append(node)
                        out.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                                 names=["node", "shingles"])

    wanted = nodes.join(classes.select("node", "first_id", "first_hash", "set_key"), "node")
    texts = (docs.withColumn("row_hash", F.md5(F.col("text").cast("binary")))
             .join(wanted, (F.col("doc_id") == F.col("first_id")) & (F.col("row_hash") == F.col("first_hash")))
             .select("node", "set_key", "text"))
    return texts.mapInArrow(sets, "node long, shingles array<bigint>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    counted = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"),
        F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))
    return counted.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node of ``edges(a, b)``; ``root`` is the component's smallest node.

    Alternating large-star and small-star: in the first, every node links its
    larger neighbours to its smallest; in the second, its smaller neighbours
    and itself. Both only join on a node with its minimum, so a hub is a
    skewed join and never a collected list. Stops when the edges no longer change.
    """
    spark = edges.sparkSession
    prepare(spark)

    def star(e: DataFrame, large: bool) -> DataFrame:
        """e holds each edge once, a > b."""
        if large:
            around = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
            least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
            out = around.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            least = e.groupBy("a").agg(F.min("b").alias("m"))
            out = e.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return out.where("a > b").distinct()

    def state(e: DataFrame):
        r = e.agg(F.count("*").alias("n"), F.sum("b").alias("s"),
                  F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return r["n"], r["s"], r["x"]

    e = write_and_reread(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .where("a > b").distinct(), "edges")
    seen = state(e)
    for _ in range(max_rounds):
        e = write_and_reread(star(star(e, True), False), "edges")
        now = state(e)
        if now == seen:
            pairs = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return pairs.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
    raise RuntimeError("components did not settle")


def _shared_buckets(bands: DataFrame) -> DataFrame:
    """``bucket, band, node, centres`` of the buckets with several classes; the centres are the first
    of the bucket in a few fixed orders."""
    orders = [F.col("node"), *(F.xxhash64("node", F.lit(k)) for k in range(1, CENTRES))]
    firsts = bands.groupBy("bucket").agg(F.max("node").alias("z"), F.min("node").alias("a"),
                                         *[F.min_by("node", o).alias(f"c{k}") for k, o in enumerate(orders)])
    firsts = firsts.where("a < z").select("bucket", F.array_distinct(
        F.array(*[f"c{k}" for k in range(CENTRES)])).alias("centres"))
    return bands.join(firsts, "bucket").select("bucket", "band", "node", "centres")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _mixed_rows(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``bucket, band, node, root, main, n`` of the buckets that hold several components: ``main`` is
    the root of the bucket's largest component, ``n`` the bucket's size."""
    placed = (shared.select("bucket", "band", "node").join(roots, "node", "left")
              .select("bucket", "band", "node", F.coalesce("root", "node").alias("root")))
    sizes = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = (sizes.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("n"),
                                         F.count("*").alias("parts")).where("parts > 1").select("bucket", "main", "n"))
    return write_and_reread(placed.join(mixed, "bucket"), "mixed")


def _samples(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, level, sample``: of each undecided class' set the upper hash words that 2^level divides.

    A set of at most ``SAMPLE`` shingles is kept whole (level 0), a larger one
    down to about that many. Two samples compare at the higher of their levels.
    """
    n = F.size("shingles")
    level = F.when(n <= SAMPLE, F.lit(0)).otherwise(F.ceil(F.log2(n / F.lit(SAMPLE)))).cast("int")
    own = sets.join(rows.select("node").distinct(), "node", "left_semi").withColumn("level", level)
    words = F.transform("shingles", lambda h: F.shiftrightunsigned(h, 32))
    return own.select("node", "level", F.sort_array(F.filter(
        words, lambda w: w % F.pow(F.lit(2.0), F.col("level")).cast("long") == 0)).alias("sample"))


class _Block:
    """The rows of one block, as arrays."""

    def __init__(self, rows: pa.StructArray):
        column = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
        self.node, self.root, self.main, self.level = map(column, ("node", "root", "main", "level"))
        self.signature = np.frombuffer(b"".join(rows.field("signature").to_pylist()), "<u2").reshape(-1, BANDS * ROWS)
        lists = rows.field("sample")
        self.words = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.count = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        self.start = np.cumsum(self.count) - self.count

    def sample(self, i: int) -> np.ndarray:
        return self.words[self.start[i]:self.start[i] + self.count[i]]

    def first_band(self, picked: np.ndarray, signature: np.ndarray) -> np.ndarray:
        """The first band that each picked row has in common with a signature."""
        same = (self.signature[picked] == signature).reshape(len(picked), BANDS, ROWS)
        return same.all(axis=2).argmax(axis=1)

    def may_reach(self, picked: np.ndarray, words: np.ndarray, level: int, percent: int) -> np.ndarray:
        """Which of the picked rows may be as similar as ``percent`` to a set with this sample.

        Whole sets (level 0) are compared as they are; samples with a margin of
        5.5 standard deviations.
        """
        p, out = percent / 100, np.zeros(len(picked), dtype=bool)
        for own in np.unique(self.level[picked]).tolist():
            at = np.flatnonzero(self.level[picked] == own)
            t = max(level, own)
            mine = words[words % (1 << t) == 0]
            count = self.count[picked[at]]
            ends = np.cumsum(count)
            theirs = self.words[np.arange(ends[-1]) + np.repeat(self.start[picked[at]] - (ends - count), count)]
            kept = theirs % (1 << t) == 0
            hit = kept & (mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs) if len(mine) else kept & False
            bound = np.concatenate([[0], ends])
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[bound])
            both = total(hit)
            union = np.maximum(len(mine) + total(kept) - both, 1)
            margin = 5.5 * np.sqrt(p * (1 - p) / union) if t else 0.0
            out[at] = (both + 1) / union >= p - margin  # one more for words that coincide by chance
        return out


def _cross_pairs(rows: DataFrame, classes: DataFrame, samples: DataFrame, least: int, percent: int) -> DataFrame:
    """Pairs ``a < b`` of different components in one bucket that may be similar, each once.

    Their signatures agree enough, and so do the samples of their sets.
    """
    rows = (rows.join(classes.select("node", "signature"), "node").join(samples, "node")
            .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    blocks = write_and_reread(rows.groupBy("bucket", "band", "block").agg(F.collect_list(F.struct(  # about BLOCK rows
        "node", "root", (F.col("root") == F.col("main")).alias("main"), "level", "sample", "signature")).alias("own")), "blocks")
    # A block meets itself and every later block of its bucket.
    ahead = blocks.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("block"),
                          F.col("own").alias("other"))
    met = blocks.join(ahead, ["bucket", "block"]).select("band", "own", "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            for k in range(batch.num_rows):
                sides = [_Block(batch.column(side)[k].values) for side in ("own", "other")]
                band = batch.column("band")[k].as_py()
                # Only classes outside the main component look for a match; each pair has such a one.
                for one, other in (sides, sides[::-1]):
                    for i in np.flatnonzero(~one.main).tolist():
                        agree = (other.signature == one.signature[i]).sum(axis=1)
                        good = np.flatnonzero((agree >= least) & (other.root != one.root[i]))
                        if len(good):  # a pair that shares several buckets is compared in the first
                            good = good[other.first_band(good, one.signature[i]) == band]
                        if len(good):
                            good = good[other.may_reach(good, one.sample(i), int(one.level[i]), percent)]
                        if len(good):
                            x, y = np.full(len(good), one.node[i]), other.node[good]
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                                             names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, row_hash, n_shingles, component_id, kept``, one row per input row.

    Two documents are linked when 100 |A & B| >= percent |A | B| for their
    distinct word shingles; ``component_id`` is the smallest ``doc_id`` reachable.

    No words, empty or null text: no shingles, linked with nothing. Null
    ``doc_id``: takes no part in linking, null ``component_id``, not kept.
    Repeated rows (same id and text) are one document, reported as often as
    they occur. Equal ids with different texts are different documents; both
    report the smallest id of their own components. Empty table: empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = id_and_text(docs, id_col, text_col)
    signed = write_and_reread(signatures(docs, size), "signed")
    linkable = signed.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = linkable.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "row_hash")).alias("first"), F.first("signature").alias("signature"))
    classes = write_and_reread(classes.select(
        F.monotonically_increasing_id().alias("node"), "set_key", F.col("first.doc_id").alias("first_id"),
        F.col("first.row_hash").alias("first_hash"), "signature"), "classes")
    least = _least_agreement(percent)
    shared = write_and_reread(_shared_buckets(_band_rows(classes)), "buckets")
    stars = (shared.select("node", F.explode("centres").alias("centre")).where("node <> centre")
             .select(*_ordered(F.col("node"), F.col("centre"))).distinct())
    sets = write_and_reread(_class_sets(shared.select("node").distinct(), classes, docs, size), "sets")

    agree = F.pandas_udf(lambda x, y: pd.Series(_agreement(x, y)), "long")
    sig = classes.select("node", "signature")
    tried = write_and_reread(
        stars.join(sig.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
        .join(sig.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
        .where(agree("x", "y") >= least).select("a", "b"), "pairs")
    edges = write_and_reread(_verified(tried, sets, percent), "links")
    roots = write_and_reread(connected_components(edges), "roots")
    rows = _mixed_rows(shared, roots)
    samples = write_and_reread(_samples(rows, sets), "samples")
    more = write_and_reread(_cross_pairs(rows, classes, samples, least, percent)
                            .join(tried, ["a", "b"], "left_anti"), "pairs")
    links = write_and_reread(_verified(more, sets, percent), "links")
    if not links.isEmpty():
        roots = connected_components(edges.union(links))

    named = classes.join(roots, "node", "left").select("set_key", "first_id", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = named.join(smallest, "root").select("set_key", "component_id")
    own = F.coalesce("component_id", "doc_id")
    return (signed.select("doc_id", "row_hash", "n_shingles", "set_key").join(by_set, "set_key", "left")
            .select("doc_id", "row_hash", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
                    F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near-duplicates.

    The one with the smallest ``(doc_id, text hash)`` stays; of repeated rows
    one stays. Rows with a null id and rows without words all stay.
    """
    found = near_duplicates(docs, size, percent, id_col, text_col)
    grouped = found.where("doc_id is not null and n_shingles > 0")
    stay = grouped.groupBy("component_id").agg(F.min(F.struct("doc_id", "row_hash")).alias("one"))
    stay = stay.select(F.col("one.doc_id").alias("__id"), F.col("one.row_hash").alias("__hash")).withColumn("__keep", F.lit(True))
    names = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.md5(text.cast("binary")),
                             "__free": F.col(id_col).isNull() | ~text.rlike(r"[^\x20\x09-\x0D]")})
    free = rows.where("__free").select(*names)
    bound = (rows.where("not __free").join(stay, ["__id", "__hash"], "left_semi")
             .dropDuplicates(["__id", "__hash"]).select(*names))
    return free.unionByName(bound)
