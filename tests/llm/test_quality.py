"""Quality rules against a plain form; the ratio against numpy; no Python in the plan."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from drawlake.llm import quality
from tests.llm.util import EDGE_ROWS, docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text)
    n = len(w)
    windows = Counter(tuple(w[i:i + 8]) for i in range(n - 7))
    covered = {i + k for i in range(n - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


TEXTS = ["a b c d e f g h a b c d e f g h", "a " * 9, "a " * 8, "x\ny\nx\n\n \nx\n", "#*$ | <p> &amp; % z\x1c", "é ü 漢字\x0b\x0cq",
         prose(1, 30) + " " + prose(1, 30), prose(1, 8) + " z " + prose(1, 8) + " " + prose(2, 40), "w " * 300 + prose(3, 100)]


def test_base_counts(spark):
    rows = EDGE_ROWS + [(100 + k, t) for k, t in enumerate(TEXTS)]
    frame = docs(spark, rows).withColumn("quality_rules", F.lit("mine"))
    out = quality.judge(frame, quality.QualityModel((), -math.inf))
    got = [(r.doc_id, *r.quality_rules[:6]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((i, *base(t or "")) for i, t in rows), key=str)
    assert all(r.quality_rules.kept != r.quality_rules.base_failed for r in out.collect())
    assert quality.judge(frame.limit(0), quality.QualityModel((), 0.0)).count() == 0


def junk(k):
    return " ".join(w + "### " + "&&&" for w in prose(k, 30).split())


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, prose(k, 50)) for k in range(150)] + [(200 + k, junk(k)) for k in range(40)] + [(300, "ta " * 5)]
    labels = [(k, 1) for k in range(0, 150, 2)] + [(200 + k, 0) for k in range(0, 40, 2)] + [(None, 1), (1, None), (0, 1)]
    frame = docs(spark, rows)
    model = quality.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int"), buckets=512)
    return rows, model, quality.judge(frame, model)


def test_clean_documents_stay_and_junk_goes(judged):
    rows, _, out = judged
    kept = {r.doc_id: r.quality_rules.kept for r in out.collect()}
    assert len(kept) == len(rows)
    assert all(kept[k] for k in range(150)) and not any(kept[200 + k] for k in range(40)) and not kept[300]


def test_ratio_by_definition(spark, judged):
    """Counts in Python over Spark's own buckets give the model's weights and scores."""
    rows, model, out = judged
    b = {}
    for r in quality.gram_buckets(docs(spark, rows), 512, "doc_id").collect():
        b.setdefault(r.doc_id, []).append(r.bucket)
    raw, good = Counter(), Counter()
    for i, own in b.items():
        raw.update(own)
        if i in range(0, 150, 2):
            good.update(own)
    n_raw, n_good = sum(raw.values()) + 512, sum(good.values()) + 512
    weight = [math.log((good[k] + 1) / n_good) - math.log((raw[k] + 1) / n_raw) for k in range(512)]
    assert model.log_ratio == pytest.approx(weight, abs=1e-6)
    for r in out.collect():
        s = r.quality_rules.score
        if not r.quality_rules.base_failed:
            assert s == pytest.approx(sum(weight[k] for k in b[r.doc_id]) / len(b[r.doc_id]), abs=1e-5)
            assert r.quality_rules.kept == (s >= model.threshold)


def test_tokens():
    assert re.findall(quality.TOKEN_PATTERN.replace(r"\p{L}\p{M}\p{N}", r"\w"), "ab,c ##") == ["ab", ",", "c", "##"]


def test_native_plan(judged, capsys):
    judged[2].explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


def test_without_trusted_documents_all_pass(spark):
    rows = [(k, prose(k, 40)) for k in range(5)]
    for labels in ([], [(1, 0)]):
        model = quality.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"))
        assert all(r.quality_rules.kept for r in quality.judge(docs(spark, rows), model).collect())
    empty = docs(spark, [])
    assert quality.judge(empty, quality.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))).count() == 0


def test_texts_move_once_at_every_size(spark, capsys, monkeypatch):
    """fit() writes no text, and neither broadcasts nor sorts beside texts even where the labels are few."""
    counted, written = [], []
    buckets, write = quality.gram_buckets, quality.write_and_reread
    monkeypatch.setattr(quality, "gram_buckets", lambda rows, *a: counted.append(rows) or buckets(rows, *a))
    monkeypatch.setattr(quality, "write_and_reread", lambda df, *a: written.append(df) or write(df, *a))
    rows = [(k, prose(k, 30)) for k in range(40)] + [(None, prose(50, 30)), (7, prose(51, 30))]
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    model = quality.fit(docs(spark, rows), labels, buckets=64)
    assert len(model.log_ratio) == 64 and model.threshold > -math.inf
    assert written and not any("text" in df.columns for df in written)
    assert sum(df.count() for df in written) == 31  # each labelled row is scored, a repeated id's rows too
    plans = []
    for df in counted + written:
        df.explain()
        plans.append(capsys.readouterr().out)
    assert sum("ShuffledHashJoin" in p for p in plans) == 2
    assert not any("Broadcast" in p or "SortMerge" in p for p in plans)
    assert counted[0].count() == 16 and counted[1].count() == len(rows)


def test_scored_once_is_judged_the_same(spark, monkeypatch):
    """judge_by_labels() gives what fit() and judge() give, and scores each text once."""
    again = " ".join([prose(3, 10)] * 9)
    rows = EDGE_ROWS[:-1] + [(100 + k, prose(k, 30)) for k in range(40)] + [(200 + k, junk(k)) for k in range(20)] + [(300, again), (100, again)]
    frame = docs(spark, rows)
    for labels in ([(100 + k, 1) for k in range(30)] + [(200 + k, 0) for k in range(15)] + [(300, 1), (None, 1), (100, 0), (101, None)],
                   [(300, 1), (100, 1)], [(200, 0)], [(4, 1)]):
        marks = spark.createDataFrame(labels, "doc_id long, quality int")
        pick = lambda df: sorted(df.select("doc_id", "quality_rules.*").collect(), key=str)
        old = pick(quality.judge(frame, quality.fit(frame, marks, 64)))
        written, write = [], quality.write_and_reread
        with monkeypatch.context() as m:
            m.setattr(quality, "write_and_reread", lambda df, *a: written.append(df) or write(df, *a))
            assert pick(quality.judge_by_labels(frame, marks, 64)) == old
        assert not any("text" in df.columns for df in written)
