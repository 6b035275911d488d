"""Toxicity scores by a subsequence-kernel support vector machine with Nyström landmarks.

Spelling is compared by the gapped subsequence kernel: two strings are alike
when they share short letter sequences in the same order, and every letter
that lies between costs a factor. So ``i.d-i o t`` and an unseen ending of an
insulting stem stay near their landmark. A linear machine on the Nyström map
of the kernel gives every word a margin, and so every run of neighbouring
pieces that together, and no fewer of them, hold all letters of a landmark
(``st up id``); a sentence is as toxic as its worst of these and a document as
its worst sentence.

Training takes a bounded sample of labelled documents. Which sentence of a
toxic document is the toxic one is not labelled, so the machine is trained in
rounds: each toxic document puts forward its highest sentence, each clean
document its highest sentences, until the choice settles (multiple instances).
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from drawlake.llm.common import forget_kept, id_and_text, kept_by_worker, prepare

#: Strings are compared in windows of so many characters, which overlap by half.
WIDTH = 24
#: Longest landmark, decay per letter of span, longest common subsequence counted.
LANDMARK, DECAY, ORDER = 10, 0.8, 4
#: Marks both ends of a word, so that a stem at its beginning differs from the same letters inside.
EDGE = "\x02"
#: Pairs compared at a time; words remembered per worker.
CHUNK, MEMO_WORDS = 512, 500_000
#: Pieces that a landmark may be broken into, and letters that may stand between its own.
MOST_PIECES, SPARE = 6, 4
#: Cost of margin violations, summed over a class.
COST = 50_000.0

_MARKS = re.compile(r"[\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+(?:\s|$)")


def _bare(raw: str) -> str:
    """A token (lower case, between white space) without what is neither letter nor digit: its piece."""
    return raw if raw.isalnum() else _MARKS.sub("", raw)


class _Table:
    """Piece, length, letters and (with a model) margin of every token met so far, by number."""

    def __init__(self, model=None):
        self.model = model
        self.start()

    def start(self) -> None:
        self.number: defaultdict = defaultdict(count().__next__)
        self.piece: list[str] = []
        self.length, self.mask, self.margin = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
        self.joined: dict[str, float] = {}

    def codes(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Number of every token that has a piece, and its text's number, text by text."""
        if len(self.number) + len(self.joined) > MEMO_WORDS:
            self.start()
        code = np.fromiter(map(self.number.__getitem__, chain.from_iterable(texts)), np.int64, sum(map(len, texts)))
        new = [_bare(w) for w in islice(reversed(self.number), len(self.number) - len(self.piece))][::-1]
        if new:
            length = np.fromiter(map(len, new), np.int64, len(new))
            mask, margin = np.zeros(len(new), dtype=np.uint64), np.zeros(len(new))
            short = np.flatnonzero((length > 0) & (length <= LANDMARK + SPARE))  # longer ones are in no run
            if len(short):
                mask[short] = _masks([new[k] for k in short.tolist()])
            if self.model is not None:
                words = np.flatnonzero(length > 1)
                margin[words] = self.model.margins([new[k] for k in words.tolist()])
            self.piece += new
            self.length, self.mask, self.margin = (np.append(x, y) for x, y in (
                (self.length, length), (self.mask, mask), (self.margin, margin)))
        doc = np.repeat(np.arange(len(texts)), list(map(len, texts)))
        some = self.length[code] > 0
        return code[some], doc[some]

    def margins_of(self, joined: list[str]) -> list[float]:
        new = [w for w in set(joined) if w not in self.joined]
        self.joined.update(zip(new, self.model.margins(new).tolist(), strict=True))
        return [self.joined[w] for w in joined]


def spelt(code: np.ndarray, doc: np.ndarray, table: _Table) -> list[tuple[int, str]]:
    """(text, word) for more than two single characters in a row, which are one word; fewer are none."""
    single = np.flatnonzero(table.length[code] == 1)
    if len(single) < 3:
        return []
    apart = np.flatnonzero((np.diff(single) != 1) | (np.diff(doc[single]) != 0)) + 1
    return [(int(doc[own[0]]), "".join([table.piece[k] for k in code[own].tolist()]))
            for own in np.split(single, apart) if len(own) > 2]


def bridges(code: np.ndarray, doc: np.ndarray, table: _Table, landmarks: tuple[str, ...]) -> list[tuple[int, str]]:
    """(text, word) for the shortest runs of 2 to ``MOST_PIECES`` neighbouring pieces that hold all letters of one of
    the (first 64) landmarks and at most ``SPARE`` characters more than it has."""
    bare = [g.replace(EDGE, "") for g in landmarks[:64]]
    if not len(code) or not bare:
        return []
    marks, room = _masks(bare), [len(g) + SPARE for g in bare]
    total = np.concatenate([[0], np.cumsum(table.length[code])])

    def covers(mask: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Bit set of the landmarks whose letters are all there, in not too long a run."""
        bits = np.zeros(len(mask), dtype=np.uint64)
        some = np.flatnonzero(size <= max(room))
        mask, size, own = mask[some], size[some], np.zeros(len(some), dtype=np.uint64)
        for k, (m, r) in enumerate(zip(marks, room, strict=True)):
            hit = np.flatnonzero((mask & m) == m)
            own[hit[size[hit] <= r]] |= np.uint64(1 << k)
        bits[some] = own
        return bits

    out = []
    mask = table.mask[code]
    run, before = mask, covers(mask, table.length[code])
    for m in range(2, min(MOST_PIECES, len(code)) + 1):
        run = run[:-1] | mask[m - 1:]
        size = total[m:] - total[:-m]
        size[doc[:-(m - 1)] != doc[m - 1:]] = LANDMARK + SPARE + 1
        now, before = covers(run, size), before[:-1] | before[1:]
        out += [(int(doc[i]), "".join([table.piece[k] for k in code[i:i + m].tolist()])) for i in np.flatnonzero(now & ~before).tolist()]
        before = now | before
    return out


def windows(word: str) -> list[str]:
    word = EDGE + word + EDGE
    if len(word) <= WIDTH:
        return [word]
    return [word[a:a + WIDTH] for a in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points, one word per column, zero-padded."""
    return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width).T.copy()


def _masks(words: list[str]) -> np.ndarray:
    """Bit sets of the letters of each word."""
    cp = _letters(words, max(map(len, words))).astype(np.uint64)
    bits = np.where(cp > 0, np.uint64(1) << (cp % np.uint64(64)), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=0)


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Unnormalised kernel of column pairs of ``s`` and ``t`` (code points, zero-padded).

    Sums, over common subsequences of 2 to ``ORDER`` letters, ``DECAY`` to the
    power of the lengths they span in both strings.
    """
    out = np.zeros(s.shape[1], dtype=np.float32)
    d = np.float32(DECAY)
    ls, lt = (s != 0).sum(axis=0), (t != 0).sum(axis=0)
    order = np.lexsort((lt, ls))  # like lengths together, so that little padding is computed
    for at in range(0, len(order), CHUNK):
        own = order[at:at + CHUNK]
        a, b = s[:ls[own].max(), own], t[:lt[own].max(), own]
        match = ((a[:, None, :] == b[None, :, :]) & (a[:, None, :] != 0)).astype(np.float32) * (d * d)
        level, total = match, np.zeros(len(own), dtype=np.float32)
        for _ in range(ORDER - 1):
            gap = np.zeros_like(level)
            for i in range(1, len(a)):
                np.multiply(gap[i - 1], d, out=gap[i])
                gap[i] += level[i - 1]
            far = np.zeros_like(level)
            for j in range(1, len(b)):
                np.multiply(far[:, j - 1], d, out=far[:, j])
                far[:, j] += gap[:, j - 1]
            level = match * far
            total += level.sum(axis=(0, 1))
        out[own] = total
    return out


def _pairs(words: list[str], landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, landmark) numbers that share all letters of the landmark but one, and three at least."""
    marks = _masks(landmarks)
    need = np.maximum(np.bitwise_count(marks).astype(int) - 1, 3)
    shared = np.bitwise_count(_masks(words)[:, None] & marks[None, :])
    return np.nonzero(shared >= need[None, :])


def similarities(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of every word with every landmark (0 where hardly a letter is shared)."""
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    i, j = _pairs(words, landmarks)
    if len(i):
        s, t = _letters(words, WIDTH), _letters(landmarks, LANDMARK)
        used = np.unique(i)
        own = np.zeros(len(words), dtype=np.float32)
        own[used] = subsequence_kernel(s[:, used], s[:, used])
        norm = own[i] * subsequence_kernel(t, t)[j]
        out[i, j] = subsequence_kernel(s[:, i], t[:, j]) / np.sqrt(np.maximum(norm, 1e-12))
    return out


def _features(margins: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Of each document's margins (in any order): the highest, how many are positive, and how dense those are."""
    most = np.full(n_docs, -2.0)
    np.maximum.at(most, doc, margins)
    hits = np.bincount(doc[margins > 0], minlength=n_docs)
    return np.stack([np.clip(most, -2, 2), np.log1p(hits), np.log1p(100 * hits / np.maximum(np.bincount(doc, minlength=n_docs), 1))], axis=1)


@dataclass(frozen=True)
class ToxicityModel:
    """Landmarks, weights of the likeness to each, and the logistic scale of a document's features."""

    landmarks: tuple[str, ...]
    weights: np.ndarray
    bias: float
    scale: np.ndarray

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word: the highest of its windows."""
        if not words or not self.landmarks:
            return np.full(len(words), self.bias)
        parts = [windows(w) for w in words]
        m = similarities([p for ps in parts for p in ps], list(self.landmarks)) @ self.weights + self.bias
        return np.maximum.reduceat(m, np.cumsum([0, *map(len, parts)])[:-1])

    def probabilities(self, texts: list[str], table: _Table | None = None) -> np.ndarray:
        """Of each text, from the margins of all its words and runs of pieces."""
        table = table or _Table(self)
        code, doc = table.codes([t.lower().split() for t in texts])
        more = spelt(code, doc, table) + bridges(code, doc, table, self.landmarks)
        words = table.length[code] > 1
        margins = np.concatenate([table.margin[code[words]], table.margins_of([w for _, w in more])])
        doc = np.concatenate([doc[words], np.array([d for d, _ in more], dtype=np.int64)])
        z = np.column_stack([_features(margins, doc, len(texts)), np.ones(len(texts))]) @ self.scale
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _substrings(words: list[str]) -> list[str]:
    return list({w[a:a + k] for w in words for k in range(4, LANDMARK + 1) for a in range(len(w) - k + 1)})


def _landmarks(docs: list[list[str]], toxic: np.ndarray, n: int) -> list[str]:
    """Substrings that best tell toxic documents apart, chosen one after another by what they newly explain.

    ``docs`` holds each document's distinct words. A substring of too few toxic
    documents cannot be chosen; those are found first, by hashes alone, so that
    only the others are kept as text.
    """
    n_toxic, n_clean = int(toxic.sum()), max(1, int((~toxic).sum()))
    rate, least = n_toxic / n_clean, max(1.0, 0.005 * n_toxic)
    sick = np.flatnonzero(toxic).tolist()
    hashes = [np.fromiter(map(hash, _substrings(docs[d])), np.int64) for d in sick]
    key, count = np.unique(np.concatenate(hashes), return_counts=True)
    key = set(key[count >= max(2, least)].tolist())
    del hashes
    where: dict[str, set[int]] = {}
    for d in sick:
        for g in _substrings(docs[d]):
            if hash(g) in key:
                where.setdefault(g, set()).add(d)
    seen: Counter[str] = Counter()
    for d in np.flatnonzero(~toxic).tolist():
        seen.update(g for g in _substrings(docs[d]) if g in where)
    cost = {g: 5 * seen[g] * rate for g in where}
    where = {g: ds for g, ds in where.items() if len(ds) > cost[g]}
    chosen: list[str] = []
    covered: Counter[int] = Counter()
    while where and len(chosen) < n:
        # A toxic document counts less the more landmarks explain it, so that each insult gets its own.
        gain = {g: sum(1 / (1 + covered[d]) ** 2 for d in ds) - cost[g] for g, ds in where.items()}
        best = max(gain, key=lambda g: (round(gain[g], 6), len(g), g))
        if gain[best] < least:
            break
        chosen.append(best)
        covered.update(where[best])
        where = {g: ds for g, ds in where.items() if g not in best and best not in g and gain[g] > 0.25}
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Primal squared-hinge linear machine by Newton steps; the last column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        xi, ci = x[inside], cost[inside]
        new = np.linalg.solve(ridge + xi.T @ (ci[:, None] * xi), xi.T @ (ci * y[inside]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _stretched(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter put into it, with one letter twice, and twice with two letters put into it."""
    def with_one(w: str) -> str:
        cut = int(rng.integers(2, max(3, len(w) - 1)))  # inside the edges
        return w[:cut] + "abcdefghijklmnopqrstuvwxyz"[int(rng.integers(0, 26))] + w[cut:]

    cut = int(rng.integers(1, max(2, len(word))))
    return [with_one(word), word[:cut] + word[cut - 1] + word[cut:], with_one(with_one(word)), with_one(with_one(word))]


def train(texts: list[str], labels: list[int], n_landmarks: int = 48, rounds: int = 6, seed: int = 7) -> ToxicityModel:
    """Fit the machine on labelled texts. Without both classes every score is the base rate."""
    toxic = np.array(labels, dtype=bool)
    prior = float(toxic.mean()) if len(toxic) else 0.0
    flat = ToxicityModel((), np.zeros(0), 0.0, np.array([0, 0, 0, np.log((prior + 0.01) / (1.01 - prior))]))
    if not toxic.any() or toxic.all():
        return flat
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    numbered = lambda words: [number.setdefault(p, len(number)) for w in words for p in windows(w)]
    table = _Table()
    said = [table.codes([ws for s in _SENTENCE.split(t) if (ws := s.lower().split())]) for t in texts]

    def by_sentence(found: list[tuple[int, str]], n: int) -> list[list[str]]:
        out: list[list[str]] = [[] for _ in range(n)]
        for k, w in found:
            out[k].append(w)
        return out

    bags = []
    for code, sentence in said:
        n = int(sentence.max()) + 1 if len(sentence) else 0
        words = by_sentence([(k, table.piece[c]) for k, c in zip(sentence.tolist(), code.tolist(), strict=True) if table.length[c] > 1], n)
        bags.append([np.array(numbered(ws + own), dtype=np.int32) for ws, own in zip(words, by_sentence(spelt(code, sentence, table), n), strict=True)])
    every = list(number)
    landmarks = _landmarks([[every[k] for k in np.unique(np.concatenate(ss)).tolist()] if ss else [] for ss in bags],
                           toxic, n_landmarks)
    if not landmarks:
        return flat
    bags = [[own for s, runs in zip(ss, by_sentence(bridges(*at, table, tuple(landmarks)), len(ss)), strict=True)
             if len(own := np.append(s, np.array(numbered(runs), dtype=np.int32)).astype(np.int32))]
            for ss, at in zip(bags, said, strict=True)]
    del said
    every = list(number)
    gram = similarities(landmarks, landmarks).astype(float)
    gram = (gram + gram.T) / 2
    value, vector = np.linalg.eigh(gram + 1e-6 * np.eye(len(gram)))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-4))) @ vector.T  # the Nyström map is k(x, landmarks) @ root
    sim = np.concatenate([similarities(every[a:a + 20_000], landmarks) for a in range(0, len(every), 20_000)])
    score = sim.max(axis=1)
    bar, before = 0.9, None
    worst: dict[tuple[int, int], int] = {}  # clean sentences put forward so far, so that no round forgets another's
    put: dict[tuple[int, int], int] = {}
    for _ in range(rounds):
        for d, ss in enumerate(bags):
            if not ss:
                continue
            top = sorted(((float(score[s].max()), int(s[score[s].argmax()])) for s in ss), reverse=True)
            if toxic[d]:  # the highest sentence, and any other that looks toxic by now
                put.update({(d, k): k for m, k in top if m >= bar or k == top[0][1]})
            else:
                worst.update({(d, k): k for _, k in top[:2]})
        up, down = list(put.values()), list(worst.values())
        if (up, down) == before:
            break
        before = (up, down)
        bent = [b for k in up for b in _stretched(every[k], rng) if len(b) <= WIDTH]
        own = np.concatenate([sim[up], similarities(bent, landmarks) if bent else np.empty((0, len(landmarks)))])
        # A word without any likeness (all zeros) is as clean as all that were put forward together.
        x = np.concatenate([own, sim[down], np.zeros((1, len(landmarks)))]).astype(float) @ root
        y = np.concatenate([np.ones(len(own)), -np.ones(len(down) + 1)])
        cost = np.where(y > 0, COST / len(own), COST / max(1, len(down)))
        cost[-1] = COST
        w = _svm(np.column_stack([x, np.ones(len(x))]), y, cost)
        weights, bias = root @ w[:-1], float(w[-1])
        score, bar = sim @ weights + bias, 0.0
    whole = [score[np.concatenate(ss)] if ss else np.empty(0) for ss in bags]
    seen = _features(np.concatenate(whole), np.repeat(np.arange(len(bags)), list(map(len, whole))), len(bags))
    return ToxicityModel(tuple(landmarks), weights, bias, _logistic(seen, toxic))


def _logistic(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights and constant of a slightly ridged logistic regression, by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ ((p * (1 - p))[:, None] * x) + 0.1 * np.eye(x.shape[1]),
                               x.T @ (p - toxic) + 0.1 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_sample(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int, max_chars: int) -> DataFrame:
    """``doc_id, toxic, text`` of a bounded sample, the same at every run: per class the first ``per_class``
    ids by hash of those whose texts have at most ``max_chars`` characters (in all rows of the id)."""
    spark = docs.sparkSession
    short = (docs.select("doc_id", F.length("text").alias("n")).where("doc_id is not null")
             .groupBy("doc_id").agg(F.max("n").alias("n")).where(F.col("n") <= max_chars).select("doc_id"))
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(short, "doc_id", "left_semi"))
    one = one.persist()
    chosen = [one.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    ids = spark.createDataFrame([(r[0], r[1]) for c in chosen for r in c.collect()], "doc_id long, toxic int")
    one.unpersist()
    return (docs.join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))


def held_out_column(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves no remainder at division by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1000, max_chars: int = 12_000,
        n_landmarks: int = 48) -> ToxicityModel:
    """Train on a sample of at most ``2 * per_class`` labelled documents that are not held out.

    ``labels`` has ``doc_id, toxic``; of several labels of one id the higher
    counts, null labels none. The bounds are the only limit on what is read for
    training; scoring always covers every row and whole texts. The sample is
    small enough for one task, which trains there and returns the model alone.
    """
    prepare(docs.sparkSession)
    sample = training_sample(id_and_text(docs), labels, held_out_column(), per_class, max_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            toxic += batch.column("toxic").to_pylist()
        model = pickle.dumps(train(texts, toxic, n_landmarks=n_landmarks))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = sample.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([], [])


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out_col`` (0 to 1), one row per input row.

    The score depends on the whole text alone. Null or empty text: the score of
    a text without words. Each worker remembers the margins of words it has
    met, up to a bound; long words are compared in overlapping windows. A
    column named ``out_col`` is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    sent, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    docs = docs.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_by_worker(key, lambda: _Table(sent.value))
        for batch in batches:
            out: list[float] = []
            for lo in range(0, batch.num_rows, 512):
                texts = [t or "" for t in batch.slice(lo, 512).column(text_col).to_pylist()]
                out.extend(table.model.probabilities(texts, table).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                             names=[*batch.schema.names, out_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out_col, DoubleType())]))
