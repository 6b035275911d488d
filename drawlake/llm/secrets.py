"""Secret scan: a random forest keeps the likely secrets among long tokens and drops false alarms.

Candidates are long unbroken tokens, and of any length and characters the values
assigned to a telling key and the credentials of a URL. Each is described by its length, how
likely its character transitions are in the corpus, how much of it dictionary
words cover, whether it looks like a path, and the words beside it. The forest
is fitted by MLlib on labelled findings; its trees are then applied inside the
tasks that read the texts, so a scan is one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from drawlake.llm.common import forget_kept, id_and_text, prepare, write_and_reread

#: What a candidate is, and words that speak for or against a secret beside it.
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{16,}")
KEY_WORDS = ("token", "secret", "password", "passwd", "apikey", "api_key", "access_key", "auth", "credential", "private")
PLAIN_WORDS = ("example", "sample", "placeholder", "commit", "checksum", "sha1", "sha256", "md5", "uuid", "http", "path")
BEFORE, AFTER = 32, 8

FEATURES = ("length", "transitions", "dictionary", "digits", "upper", "switches", "entropy", "distinct", "slashes",
            "dashes", "path", "key_word", "assigned", "quoted", "plain_word", "said", "in_url")
_KEY = re.compile("|".join(KEY_WORDS))
#: A value after "=" or ":" (and after the scheme of a header), the end of a telling name before
#: that, the credentials in a URL, and what stands before a value given without a sign.
_VALUE = re.compile(r"""[=:](?=>?[ \t]*(?:(?:[Bb]earer|[Bb]asic|[Tt]oken)[ \t]+)?(?:"([^"\n]+)"|'([^'\n]+)'"""
                    r"""|["']?((?:(?![,;&][ \t]*[\w.-]+[ \t]*[=:])[^\s"'])+)))""")
_KEY_END = re.compile(f"(?:{'|'.join(KEY_WORDS)})[a-z0-9_.-]*[\"'\\]]*[ \\t]*[:=]?$")
_URL = re.compile(r"//(?:[^\s/@:]*:)?([^\s/@]+)@")
_URL_BEFORE = re.compile(r"//[^\s/@]*$")
_SAID = re.compile(f"(?:bearer|basic|{'|'.join(KEY_WORDS)})[\"']?\\s+[\"']?$")
_PLAIN = re.compile("|".join(PLAIN_WORDS))
_WORD = re.compile(r"[a-z]{3,}")

#: Words of the dictionary at most (the most frequent of the corpus), and their lengths.
DICTIONARY_WORDS, SHORTEST, LONGEST = 20_000, 3, 10


@dataclass(frozen=True)
class CorpusStatistics:
    """Log probability of a character after another (ASCII), and the frequent words of the corpus."""

    transitions: np.ndarray
    dictionary: frozenset[str]


def statistics(docs: DataFrame) -> CorpusStatistics:
    """Counted over every whole text of ``doc_id, text``; at most 128 x 128 pairs and the
    ``DICTIONARY_WORDS`` most frequent words reach the driver."""
    prepare(docs.sparkSession)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        count = np.zeros(128 * 128, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                blob = b"\n".join(batch.slice(lo, 512).column("text").cast(pa.binary()).to_pylist())
                c = np.frombuffer(blob, np.uint8).astype(np.int64)
                both = (c[:-1] < 128) & (c[1:] < 128)
                count += np.bincount(c[:-1][both] * 128 + c[1:][both], minlength=128 * 128)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(128 * 128)), pa.array(count)], names=["pair", "n"])

    text = docs.select("text")
    count = np.ones(128 * 128)
    for r in text.mapInArrow(pairs, "pair long, n long").where("n > 0").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        count[r["pair"]] += r["n"]
    count = count.reshape(128, 128)
    words = write_and_reread(
        text.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
        .where(F.length("word").between(SHORTEST, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
        .where("n > 1"), "words")
    # The most frequent words, by powers of two of their counts; within the power that the bound falls into, the
    # first by hash, so that the dictionary changes little when a count does. One row per power reaches the driver.
    words = words.withColumn("power", F.floor(F.log2("n")).cast("int"))
    sizes = sorted(((r["power"], r["n"]) for r in words.groupBy("power").agg(F.count("*").alias("n")).collect()), reverse=True)
    room, whole, edge = DICTIONARY_WORDS, [], None
    for k, n in sizes:
        if n > room:
            edge = (k, n)
            break
        whole.append(k)
        room -= n
    chosen = {r["word"] for r in words.where(F.col("power").isin(whole)).select("word").collect()}
    if edge and room:
        chosen |= {r["word"] for r in first_by_hash(words.where(F.col("power") == edge[0]).select("word"), ["word"], edge[1], room).collect()}
    return CorpusStatistics(np.log(count / count.sum(axis=1, keepdims=True)), frozenset(chosen))


def first_by_hash(rows: DataFrame, columns: list[str], n_rows: int, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hashes of the columns. Only rows below a hash that about ``2 n`` of the
    ``n_rows`` rows reach take part, so that what tasks send for it does not grow with the table."""
    h = F.xxhash64(*columns)
    if n_rows > 4 * n:
        reach = int(2 * n / n_rows * 2 ** 53)
        low = rows.where(F.shiftrightunsigned(h, 11) < reach)
        if low.count() >= n:
            rows = low
    return rows.orderBy(F.shiftrightunsigned(h, 11), *columns).limit(n)


def _coverage(token: str, dictionary: frozenset[str]) -> float:
    """Share of characters inside dictionary words, longest first from the left."""
    covered = 0
    for run in _WORD.findall(token.lower()):
        at = 0
        while at + SHORTEST <= len(run):
            for n in range(min(LONGEST, len(run) - at), SHORTEST - 1, -1):
                if run[at:at + n] in dictionary:
                    covered += n
                    at += n
                    break
            else:
                at += 1
    return covered / len(token)


def describe(token: str, before: str, after: str, stats: CorpusStatistics) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    n = len(token)
    code = np.minimum(np.frombuffer(token.encode(errors="replace"), np.uint8), 127)  # all beyond ASCII counts as one sign
    kind = np.select([(code >= 48) & (code < 58), (code >= 65) & (code < 91), (code >= 97) & (code < 123)], [0, 1, 2], 3)
    counts = np.array(list(Counter(token).values())) / n
    before = before.lower()
    near = before.rstrip("\"' ")
    steps = stats.transitions[code[:-1], code[1:]] if len(code) > 1 else np.array([-np.log(128)])
    return [float(n), float(steps.mean()), _coverage(token, stats.dictionary),
            float((kind == 0).mean()), float((kind == 1).mean()), float((kind[1:] != kind[:-1]).mean()) if len(code) > 1 else 0.0,
            float(-(counts * np.log2(counts)).sum()), len(counts) / n, float(token.count("/")),
            float(token.count("-") + token.count("_")),
            float(token.startswith("/") or token.count("/") > 1 or before.endswith((".", "/", ":")) or after.startswith((".", ":"))),
            float(bool(_KEY.search(before))), float(near.endswith(("=", ":"))), float(before.endswith(("\"", "'"))),
            float(bool(_PLAIN.search(before) or _PLAIN.search(token.lower()))), float(_said(before)),
            float(_in_url(before, after))]


def _said(before: str) -> bool:
    """Whether a value stands right after a telling word without a sign between."""
    return bool(_SAID.search(before.lower()))


def _in_url(before: str, after: str) -> bool:
    """Whether a value stands in a URL before its host."""
    return after.startswith("@") and bool(_URL_BEFORE.search(before))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans in their order, without overlaps: what is assigned to a telling key counts whole, and of
    long tokens around it what is left."""
    given = [m.span(1) for m in _URL.finditer(text)]
    for m in _VALUE.finditer(text):
        if _KEY_END.search(text[max(0, m.start() - BEFORE):m.start()].lower()):
            start, end = m.span(m.lastindex)
            if m.lastindex == 3:
                end = start + len(text[start:end].rstrip(".,;:)]}>"))
            if start < end:
                given.append((start, end))
    if not given:
        return [m.span() for m in CANDIDATE.finditer(text)]
    out, done = [], 0
    for start, end in sorted(given):
        if end > done:
            out.append((max(start, done), end))
            done = end
    edges = [0, *(e for span in out for e in span), len(text)]
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        out += [m.span() for m in CANDIDATE.finditer(text, lo, hi)]
    return sorted(out)


def _beside(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - BEFORE):start], text[end:end + AFTER]


def rule_label(token: str, before: str, after: str = "") -> int | None:
    """Label of a finding by rule: 1 for a mixed, uneven value assigned to a telling key; 0 for a
    word, a number or anything that no key is near; None where neither is sure."""
    near = before.lower().rstrip("\"' ")
    mixed = any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
    counts = np.array(list(Counter(token).values())) / len(token)
    key = bool(_KEY.search(before.lower()) or _KEY.search(after.lower()))
    if _KEY.search(before.lower()) and near.endswith(("=", ":")):
        whole = CANDIDATE.fullmatch(token) or (before.endswith(("\"", "'")) and not re.search(r"\s", token))
        return 1 if whole and mixed and -(counts * np.log2(counts)).sum() >= 3 else None
    if key or near.endswith(("=", ":")) or _said(before) or _in_url(before, after):
        return None if mixed else 0
    return 0


def made_up_findings(n: int = 300) -> list[tuple[str, str, str, int]]:
    """Labelled findings (token, before, after, label) of forms that a corpus may lack; the same at every call."""
    out = []
    for k in range(n):
        d = hashlib.sha512(str(k).encode()).hexdigest()
        mixed = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"[int(d[i:i + 2], 16) % 62]
                        for i in range(0, 80, 2))
        size = 16 + int(d[:2], 16) % 24
        key = KEY_WORDS[k % len(KEY_WORDS)]
        out.append((d[:size] if k % 2 else mixed[:size], f'{key} {"=:"[k % 3 // 2]} "', '"', 1))
        plain = [(d[:40], " commit ", " "), (f"{d[:8]}-{d[8:12]}-{d[12:16]}-{d[16:20]}-{d[20:32]}", " uuid ", " "),
                 (f"/usr/share/{d[0]}lib/modules/data", " path ", " "), ("x" * size, f'{key} = "', '"'),
                 (f"your_{key}_placeholder_here", f'{key} = "', '"'), (str(int(d[:16], 16))[:16].zfill(16), " ", " "),
                 ("example_" + d[:12], f'{key}: "', '"')][k % 7]
        out.append((*plain, 0))
        signs = "".join(c + "!#$%&*?@^~"[int(d[i], 16) % 10] * (i % 5 == 2) for i, c in enumerate(mixed[:8 + k % 8]))
        forms = [(d[:size], "Authorization: Bearer ", " "), (mixed[:size], f" {key} ", " "),
                 ("ghp_" + (d if k % 2 else mixed)[:size], " https://", "@host/"), (signs, " https://user:", "@host/"),
                 (signs, f'{key} = "', '"'), (signs, f"{key}: ", " "), (mixed[:8 + k % 8], f"{key}=", "\n")]
        out += [(*forms[k % 7], 1), (*forms[(k + 2 + k // 7 % 2) % 7], 1)]
        word = ("string", "none", "true", "the", "required", "value", "required;", "a", "<hidden>", "user", "null")[k % 11]
        forms = [(word, f"{key}: ", " "), (word, f'{key} = "', '"'), (f"self.{word}", f"{key}=", ","),
                 (f"get_{word}()", f"{key} = ", "\n"), ("internationalization", f" {key} ", " "),
                 (f"see the {word}", f'{key}: "', '"'), (str(k), f"{key}: ", " ")]
        out += [(*forms[k % 7], 0), (*forms[(k + 2 + k // 7 % 2) % 7], 0)]
    return out


_FINDING = "token string, before string, after string, label int"


def labelled_findings(docs: DataFrame, per_class: int = 5_000) -> DataFrame:
    """``token, before, after, label``: at most ``per_class`` different findings of either label in the corpus,
    the first by hash, of any length. Equal findings count once, so copies cannot crowd out others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                for s, e in candidates(text):
                    token, before, after = _beside(text, s, e)
                    label = rule_label(token, before, after)
                    if label is not None:
                        out.append((token, before, after, label))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int32())],
                                                 names=["token", "before", "after", "label"])

    found = write_and_reread(docs.select("text").mapInArrow(run, _FINDING).distinct(), "findings")
    counts = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [first_by_hash(found.where(F.col("label") == k), ["token", "before", "after"], counts.get(k, 0), per_class) for k in (1, 0)]
    return write_and_reread(chosen[0].unionByName(chosen[1]), "sample")


@dataclass(frozen=True)
class SecretModel:
    """Corpus statistics and the trees: per tree, arrays of feature, threshold, left, right, vote."""

    stats: CorpusStatistics
    trees: tuple[tuple[np.ndarray, ...], ...]

    def probability(self, features: np.ndarray) -> np.ndarray:
        """Share of trees that vote for a secret."""
        votes = np.zeros(len(features))
        rows = np.arange(len(features))
        for feature, threshold, left, right, vote in self.trees:
            at = np.zeros(len(features), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                go_left = features[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            votes += vote[at]
        return votes / max(1, len(self.trees))


_NODE = re.compile(r"(If|Else) \(feature (\d+) (?:<=|>) ([-0-9.eE]+)\)|Predict: ([0-9.]+)")


def _trees(description: str) -> tuple[tuple[np.ndarray, ...], ...]:
    """Trees from a fitted forest's own description (MLlib's ``toDebugString``)."""
    out = []
    for text in re.split(r"Tree \d+ \(weight [0-9.]+\):", description)[1:]:
        lines = [m.groups() for m in _NODE.finditer(text)]
        nodes: list[list[float]] = []

        def read(at: int, nodes=nodes, lines=lines) -> tuple[int, int]:
            """Index of the node that begins at a line, and the line after it."""
            own = len(nodes)
            word, feature, threshold, vote = lines[at]
            nodes.append([-1, 0, 0, 0, 0])
            if vote is not None:
                nodes[own][4] = float(vote)
                return own, at + 1
            left, at = read(at + 1)
            right, at = read(at + 1)  # the line between is the "Else" of this node
            nodes[own] = [int(feature), float(threshold), left, right, 0]
            return own, at

        read(0)
        a = np.array(nodes)
        out.append((a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]))
    return tuple(out)


def fit(docs: DataFrame, findings: list[tuple[str, str, str, int]] | None = None, per_class: int = 5_000,
        trees: int = 24, depth: int = 8, seed: int = 11) -> SecretModel:
    """Fit on labelled findings (token, text before, text after, label).

    By default those are the findings that :func:`rule_label` is sure of, at
    most ``per_class`` of either label, and :func:`made_up_findings`. The
    statistics behind the features count all documents.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = id_and_text(docs)
    stats = statistics(docs)
    found = labelled_findings(docs, per_class) if findings is None else spark.createDataFrame(list(findings), _FINDING)
    found = found.unionByName(spark.createDataFrame(made_up_findings(), _FINDING))
    sent = spark.sparkContext.broadcast(stats)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        for batch in batches:
            x = [describe(t, b, a, sent.value) for t, b, a in zip(*(batch.column(c).to_pylist() for c in ("token", "before", "after")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.float64()), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    described = found.mapInArrow(features, "label double, x array<double>")
    # Of bounded size; one partition in one order, so that the forest is the same at every run.
    data = write_and_reread(described.repartition(1).sortWithinPartitions("label", "x"), "described").select(
        "label", array_to_vector("x").alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data.coalesce(1))
    return SecretModel(stats, _trees(forest.toDebugString))


def scan(docs: DataFrame, model: SecretModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secrets``: array<struct<start, end, probability, kept>> of the
    candidates, one row per input row; ``kept`` marks those that the forest takes for secrets.

    Positions count code points, end exclusive. Null or empty text: no
    candidates. A column named ``secrets`` is replaced. Whole texts are read;
    one task handles one batch of rows at a time.
    """
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    docs = docs.drop("secrets")
    kind = "array<struct<start:bigint,end:bigint,probability:double,kept:boolean>>"
    found_type = spark.createDataFrame([], f"secrets {kind}").schema["secrets"].dataType
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("kept", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        model = sent.value
        for batch in batches:
            out = []
            for lo in range(0, batch.num_rows, 256):
                texts = batch.slice(lo, 256).column(text_col).to_pylist()
                spans = [candidates(t or "") for t in texts]
                features = [describe(*_beside(t, s, e), model.stats)
                            for t, own in zip(texts, spans, strict=True) for s, e in own]
                p = iter(model.probability(np.array(features)).tolist() if features else [])
                out += [[{"start": s, "end": e, "probability": (q := next(p)), "kept": q > threshold} for s, e in own]
                        for own in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow)], names=[*batch.schema.names, "secrets"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("secrets", found_type)]))


def redact(text, secrets):
    """The text (a column) with every kept span replaced by ``[SECRET]``."""
    kept = F.filter(secrets, lambda s: s["kept"])
    ends = lambda k: F.when(k == 0, F.lit(0).cast("long")).otherwise(F.get(kept, k - 1)["end"])
    pieces = F.transform(kept, lambda s, k: F.concat(
        F.substring(text, (ends(k) + 1).cast("int"), (s["start"] - ends(k)).cast("int")), F.lit("[SECRET]")))
    rest = F.substring(text, (F.element_at(kept, -1)["end"] + 1).cast("int"), F.length(text))
    return F.when(F.size(kept) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), rest))
