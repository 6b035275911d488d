"""Quality rules: base counts and a hashed n-gram log-likelihood ratio, in DataFrame functions alone.

Two multinomials over hashed uni- and bigrams are compared: one counted over
the trusted documents, one over the whole corpus. A document's score is the
mean log ratio of its n-grams, so long and short texts are judged alike, and a
fixed threshold decides on every document without any draw.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import id_and_text, words_of, write_and_reread
from drawlake.llm.native import let
from drawlake.operators.sequence import global_sequence

#: Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

#: A run of letters, marks, digits and underscores, or a run of other characters that are no white space.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+|[^\x20\x09-\x0D\p{L}\p{M}\p{N}_]+"
#: What a token's hash counts as if it repeats the one before.
AGAIN = 2


def repeated_words(words: Column) -> Column:
    """Words inside some 8-word window that the text holds twice or more (the first one included)."""
    def doubled(h: Column, k: int) -> Column:
        """Hashes of the runs of 2 k words from those of the runs of k words."""
        n = F.greatest(F.size(h) - k, F.lit(0))
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(k + 1), n), lambda x, y: F.xxhash64(x, y))

    def covered(w: Column) -> Column:
        def twice(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            again = F.filter(s, lambda x, k: ((k > 0) & same(x, k - 1)) | same(x, k + 1))
            starts = F.sort_array(F.transform(again, lambda x: x["i"]))
            first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(starts, first, lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")), lambda acc: acc["n"])

        by_hash = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(by_hash, twice))

    def counted(h: Column) -> Column:
        # Most texts repeat no four words, and so no eight.
        four = let(doubled(h, 1), lambda two: doubled(two, 2))
        return let(four, lambda f: F.when(F.size(F.array_distinct(f)) == F.size(f), F.lit(0))
                   .otherwise(let(doubled(f, 4), covered)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), counted).cast("long")


def base_counts(text: Column) -> Column:
    """struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words> of one text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.when(text.rlike(SYMBOLS), F.regexp_count(text, F.lit(SYMBOLS))).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


def _token_pairs(text: Column) -> Column:
    """array<struct<x, y>>: hashes of every token (y) and of the one before it (x, null for the first)."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
    before = lambda h: F.concat(F.array(F.lit(None).cast("long")), F.slice(h, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0))))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.when(
        F.size(h) > 0, F.arrays_zip(before(h).alias("x"), h.alias("y"))).otherwise(F.array().cast("array<struct<x:bigint,y:bigint>>")))


def _buckets(x: Column, y: Column, buckets: int) -> tuple[Column, Column]:
    """Buckets of a token and of the pair it ends (null for the first token). A token that repeats the
    one before it counts as :data:`AGAIN`, so that long runs are one n-gram."""
    y = F.when(x == y, F.lit(AGAIN).cast("long")).otherwise(y)
    number = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    return number(y), F.when(x.isNotNull(), number(F.xxhash64(x, y)))


def gram_buckets(rows: DataFrame, buckets: int, *by: str) -> DataFrame:
    """``bucket`` of every n-gram of the column ``text``, one row each, beside the columns ``by``."""
    pairs = rows.select(*by, F.inline(_token_pairs(F.col("text"))))
    return (pairs.select(*by, F.explode(F.array(*_buckets(F.col("x"), F.col("y"), buckets))).alias("bucket"))
            .where("bucket is not null"))


@dataclass(frozen=True)
class QualityModel:
    """Log ratios per bucket, and the score under which a document is rejected."""

    log_ratio: tuple[float, ...]
    threshold: float

    def score(self, text: Column) -> Column:
        """Mean log ratio of the text's n-grams; 0 for a text without any, and without a trusted sample."""
        if not self.log_ratio:
            return F.lit(0.0)
        table = F.split(F.lit(",".join(map(repr, self.log_ratio))), ",").cast("array<double>")

        def step(total: Column, pair: Column) -> Column:
            one, two = _buckets(pair["x"], pair["y"], len(self.log_ratio))
            return total + F.element_at(table, one + 1) + F.coalesce(F.element_at(table, two + 1), F.lit(0.0))

        return let(_token_pairs(text), lambda p: F.when(F.size(p) == 0, F.lit(0.0)).otherwise(
            F.aggregate(p, F.lit(0.0), step) / (2 * F.size(p) - 1)))


def _one_label(labels: DataFrame) -> DataFrame:
    """``doc_id, quality`` of the labelled ids; of several labels of one id the lower counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where("doc_id is not null and quality in (0, 1)")
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))


def _ratios(docs: DataFrame, one: DataFrame, buckets: int) -> QualityModel:
    """The model that passes everything, with the log ratios of both multinomials (none without trusted documents).

    The texts are shuffled once, beside the trusted ids, and not sorted: only
    the ids are held in memory. The hint keeps it so at every size.
    """
    def counted(rows: DataFrame) -> list[int]:
        out = [1] * buckets
        for r in gram_buckets(rows, buckets).groupBy("bucket").count().collect():  # one row per bucket at most
            out[r["bucket"]] += r["count"]
        return out

    good = counted(docs.join(one.where("quality = 1").hint("shuffle_hash"), "doc_id", "left_semi"))
    if sum(good) == buckets:
        return QualityModel((), -math.inf)
    raw = counted(docs)
    n_raw, n_good = sum(raw), sum(good)
    return QualityModel(tuple(round(math.log(g / n_good) - math.log(r / n_raw), 6) for g, r in zip(good, raw, strict=True)), -math.inf)


def _threshold(scored: DataFrame, one: DataFrame) -> float:
    """The score under which a document is rejected, from ``doc_id, score`` of all documents that can be judged."""
    judged = scored.join(one.hint("shuffle_hash"), "doc_id").select("quality", "score", "doc_id")
    low = class_quantiles(judged, {1: 0.005, 0: 0.5})
    if 1 not in low:
        return -math.inf
    edge = low[1]
    middle = (edge + low[0]) / 2 if 0 in low else edge - 0.2
    return min(edge, middle)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = 4096) -> QualityModel:
    """Count both multinomials and set the threshold, from every document and every label.

    The raw-corpus counts cover all documents, the trusted ones all labelled
    ``quality = 1``. The threshold lies halfway between the lowest two hundredth
    of the trusted scores and the median of the scores of documents labelled 0,
    and never above the first. Counts are smoothed by one per bucket. Without
    trusted documents every document passes. Of several labels of one id the
    lower counts. The driver holds one count per bucket and four scores.

    For the threshold every document is scored where it is read, so that no
    text is written and only ids and scores meet the labels.
    """
    docs, one = id_and_text(docs), _one_label(labels)
    model = _ratios(docs, one, buckets)
    if not model.log_ratio:
        return model
    text = F.col("text")
    scored = docs.where(F.size(words_of(text)) >= LEAST_WORDS).select("doc_id", model.score(text).alias("score"))
    return QualityModel(model.log_ratio, _threshold(scored, one))


def class_quantiles(judged: DataFrame, wanted: dict[int, float]) -> dict[int, float]:
    """The exact quantile (between neighbours: interpolated) of ``score`` that is wanted of each ``quality`` class.

    The scores are sorted as a whole and the few at the wanted places looked
    up; the ``doc_id`` spreads equal scores over partitions.
    """
    ranked = global_sequence(write_and_reread(judged, "scores"), ["quality", "score", "doc_id"], "place")
    spot = {r["quality"]: r["first"] + (r["n"] - 1) * wanted[r["quality"]] for r in
            ranked.groupBy("quality").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()}
    places = sorted({f(at) for at in spot.values() for f in (math.floor, math.ceil)})
    at = {r["place"]: r["score"] for r in ranked.where(F.col("place").isin(places)).collect()}
    return {k: at[math.floor(x)] + (x - math.floor(x)) * (at[math.ceil(x)] - at[math.floor(x)]) for k, x in spot.items()}


def _measures(text: Column, model: QualityModel, scored: Callable[[Column], Column]) -> Column:
    """The base counts, ``base_failed`` and, where ``scored`` says so of them, the score of a text."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return let(base_counts(text), lambda c: F.struct(
        *(c[name].alias(name) for name in counts), _failed(c).alias("base_failed"),
        F.when(scored(c), model.score(text)).alias("score")))


def _failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


def _verdict(m: Column, threshold: float) -> Column:
    """The measures, with a score only where the base rules pass, and ``kept``."""
    score = F.when(~m["base_failed"], m["score"])
    return F.struct(*(m[name].alias(name) for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
        score.alias("score"), F.coalesce(score >= threshold, F.lit(False)).alias("kept"))


def judge(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and a struct ``quality_rules`` with the base counts, ``base_failed``,
    ``score`` and ``kept``, one row per input row.

    A null text has no words, and so fails the base rules. A column named
    ``quality_rules`` is replaced; the id is not used.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("quality_rules", let(_measures(text, model, lambda c: ~_failed(c)),
                                                lambda m: _verdict(m, model.threshold)))


def judge_by_labels(docs: DataFrame, labels: DataFrame, buckets: int = 4096) -> DataFrame:
    """``doc_id`` and the struct ``quality_rules`` of :func:`judge` by the model of :func:`fit`, one row per input row.

    Every text is scored once: the scores that set the threshold are written
    with the counts (and without texts), and judged by it.
    """
    rows, one = id_and_text(docs), _one_label(labels)
    model = _ratios(rows, one, buckets)
    measured = write_and_reread(rows.select("doc_id", _measures(
        F.col("text"), model, lambda c: c["n_words"] >= LEAST_WORDS).alias("m")), "measured")
    threshold = -math.inf
    if model.log_ratio:
        threshold = _threshold(measured.where("m.score is not null").select("doc_id", "m.score"), one)
    return measured.select("doc_id", _verdict(F.col("m"), threshold).alias("quality_rules"))
