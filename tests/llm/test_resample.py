"""Resampling against its plain definition; hashes and ranks one by one."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drawlake.llm import resample as R
from drawlake.llm.common import write_and_reread
from drawlake.llm.plain_words import plain_words
from tests.llm.util import EDGE_ROWS, docs, prose

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def features(text):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORD.findall(text or "")]
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)], len(w)


def brute(rows, target, percent=25, buckets=10_000, least=20):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    raw = Counter(bucket(x) for _, t in rows for x in features(t)[0])
    aim = Counter(bucket(x) for t in target for x in features(t)[0])
    s, t = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    out = []
    for doc, text in rows:
        f, n = features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], 2 ** 63 if r[0] is None else r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def run(spark, rows, target, **kw):
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    got = R.resample(docs(spark, rows), aim, **kw)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_equals_definition(spark, percent):
    rows = [(k, prose(k % 90, 5 + k % 60)) for k in range(400)] + [(k, "Ünï 7 tö " * 8) for k in range(500, 700)]
    target = [prose(k, 40) for k in range(5)] + [None, ""]
    assert run(spark, rows, target, percent=percent) == brute(rows, target, percent)


def test_edges(spark):
    target = ["one two", None]
    rows = [*EDGE_ROWS, (None, "null id too"), (-4, "x" * 300 + " " + "y" * 70 + " z")]
    # Rows that are equal in id and score may swap ranks, so the repeated rows are compared without.
    got, want = run(spark, rows, target, least_words=1, percent=100), brute(rows, target, 100, least=1)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert sorted(r[5] or 0 for r in got) == sorted(r[5] or 0 for r in want)
    assert run(spark, [], target) == []
    assert run(spark, rows, []) != [] and run(spark, rows, target)[0][5] is None


@given(st.lists(st.text(alphabet=st.sampled_from("aZ9 é漢\x00-\n"), max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_hashes_by_table(texts):
    texts += ["w" * 63 + " " + "v" * 64, "w " + "v" * 65 + " u"]
    words = [plain_words(t.encode()) for t in texts]
    hashes, n = R.feature_hashes(words)
    assert n.tolist() == [len(features(t)[0]) for t in texts]
    at = 0
    for t, k in zip(texts, n.tolist(), strict=True):
        assert Counter(hashes[at:at + k].tolist()) == Counter(zlib.crc32(x.encode()) for x in features(t)[0])
        at += k


@pytest.mark.parametrize("first", [None, 0, 1, 777])
def test_ranks_with_a_key_that_half_of_all_rows_share(spark, first):
    rnd = random.Random(1)
    keys = [(7 if rnd.random() < 0.5 else rnd.randint(-50, 50), rnd.choice([1, 1, 1, 2, -2]), k) for k in range(3000)]
    rows = write_and_reread(spark.createDataFrame(keys, "key long, tie long, row long").repartition(7, F.xxhash64("row")), "t")
    got = dict(map(tuple, R.rank_rows(rows, first).collect()))
    order = [k[2] for k in sorted(keys)][:3000 if first is None else first]
    assert got == {row: k + 1 for k, row in enumerate(order)}


def test_splitters_cut_between_equal_keys():
    run = np.array(sorted([(k % 2, 5, k) for k in range(20)]), dtype=np.int64)
    for splitter in [(0, 5, 0), (0, 5, 9), (0, 6, 0), (1, 5, 21), (-1, 0, 0), (2, 0, 0)]:
        assert R._below(run, splitter) == sum(tuple(r) < splitter for r in run.tolist())
