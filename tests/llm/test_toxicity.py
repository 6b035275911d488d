"""Toxicity: the kernel against its definition, held-out accuracy, odd spellings."""

import itertools
import random
import zlib

import numpy as np
import pytest

from drawlake.llm import toxicity as tox
from tests.llm.util import EDGE_ROWS, docs, prose

INSULTS = ["numskull", "blockhead", "dimwit", "nitwit"]


def brute_kernel(s, t):
    """Sum over pairs of index tuples that spell the same letters."""
    total = 0.0
    for n in range(2, tox.ORDER + 1):
        for a in itertools.combinations(range(len(s)), n):
            for b in itertools.combinations(range(len(t)), n):
                if all(s[i] == t[j] for i, j in zip(a, b)):
                    total += tox.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


@pytest.mark.parametrize("s,t", [("cat", "cart"), ("nitwit", "nitwit"), ("abab", "ba"), ("xyz", "abc"), ("aaa", "aa"), ("équipe", "equip")])
def test_kernel_definition(s, t):
    a, b = (tox._letters([w], tox.WIDTH) for w in (s, t))
    assert tox.subsequence_kernel(a, b)[0] == pytest.approx(brute_kernel(s, t), rel=1e-4)


def corpus(n, seed):
    rnd = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = prose(seed * 100_000 + k, 60).split()
        toxic = k % 4 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                words[rnd.randrange(60)] = rnd.choice(INSULTS)
        for p in range(9, 60, 10):
            words[p] += "."
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus(600, 1)
    model = tox.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    return rows, dict(labels), model


def test_held_out_accuracy(spark, fitted):
    rows, labels, model = fitted
    out = {r.doc_id: r.score for r in tox.score(docs(spark, rows).drop("score"), model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    wrong = [i for i in held if (out[i] >= 0.5) != bool(labels[i])]
    assert len(held) > 80 and len(wrong) <= 0.02 * len(held)


def test_odd_spellings(fitted):
    model = fitted[2]
    score = lambda text: model.probabilities([text])[0]
    plain = prose(5, 30)
    assert score(plain) < 0.5
    for w in ("dimwit", "dim-wit", "d.i.m.w.i.t", "d i m w i t", "dimxwit", "dimmwit", "DIMWIT!!", "block*head",
              "dim wit", "di mw it", "dimw it", "d im wit", "block head", "bl oc kh ea d", "num skull", "dixmzwit", "blockqhyead"):
        assert score(f"{plain} {w} {plain}") >= 0.5, w


def test_score_reads_the_whole_text_and_nothing_else(spark, fitted):
    model = fitted[2]
    long = "ta ri mo " * 40_000
    rows = EDGE_ROWS + [(50, long), (51, long + "nitwit blockhead nitwit " * 400), (52, "x" * 9_000 + "nitwit")]
    got = tox.score(docs(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3] < 0.5 and by[50] < 0.5 <= by[51]
    assert model.margins(["x" * 9_000 + "nitwit"])[0] > model.margins(["x" * 9_000])[0]


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = tox.fit(docs(spark, EDGE_ROWS), none)
    assert {r.score for r in tox.score(docs(spark, EDGE_ROWS), model).collect()} == {model.probabilities([""])[0]}
    assert tox.score(docs(spark, []), model).count() == 0
    one_class = spark.createDataFrame([(4, 1), (6, 1), (None, 0), (5, None)], "doc_id long, toxic int")
    assert tox.score(docs(spark, EDGE_ROWS), tox.fit(docs(spark, EDGE_ROWS), one_class)).count() == len(EDGE_ROWS)
