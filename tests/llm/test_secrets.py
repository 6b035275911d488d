"""Secret scan: trees equal MLlib's, held-out findings, redaction."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from drawlake.llm import secrets
from tests.llm.util import EDGE_ROWS, docs, prose


def hexes(k, n=40):
    return hashlib.sha256(f"s{k}".encode()).hexdigest()[:n]


def corpus():
    rows = []
    for k in range(120):
        text = prose(k, 60)
        if k % 3 == 0:
            text += f' token = "{hexes(k)}" ' + prose(k + 300, 5)
        if k % 4 == 0:
            text += f" card {4000000000000000 + k} commit {hexes(k + 1000)} /usr/share/lib/module_{k}/file.txt"
        rows.append((k, text))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fit(docs(spark, corpus()))


def test_finds_secrets_and_drops_false_alarms(spark, model):
    fresh = [(k + 500, t) for k, t in enumerate([
        f'see token = "{hexes(7001)}" here', f'api_key: {hexes(7002, 32)} end', f"commit {hexes(7003)} fixes it",
        "the number 4716962573099581 is a card", "an unthinkableinternationalization word", 'password = "your_password_placeholder"'])]
    out = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kept] for r in secrets.scan(docs(spark, fresh), model).collect()}
    at = {i: [m.span() for m in re.finditer(r"[0-9a-f]{32,}", t)] for i, t in fresh}
    assert out[500] == at[500] and out[501] == at[501]
    assert out[502] == out[503] == out[504] == out[505] == []


def test_secrets_of_other_forms(spark, model):
    """Headers, URLs, values without a sign and short values; and words in the same places."""
    hidden = {600: (f"Authorization: Bearer {hexes(8001)} sent", hexes(8001)), 601: (f"the auth token {hexes(8002)} is", hexes(8002)),
              602: (f"clone https://ghp_{hexes(8003, 30)}@host/x", f"ghp_{hexes(8003, 30)}"),
              603: ('password = "S3cr!t#2024" here', "S3cr!t#2024"), 604: (f"set token={hexes(8004)}\nnext", hexes(8004))}
    plain = {605: "password: string", 606: "the token: the word", 607: 'secret = "none"', 608: "a secret: é"}
    rows = [(i, t) for i, (t, _) in hidden.items()] + list(plain.items())
    out = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kept] for r in secrets.scan(docs(spark, rows), model).collect()}
    assert {i: [t[s:e] for s, e in out[i]] for i, (t, _) in hidden.items()} == {i: [v] for i, (_, v) in hidden.items()}
    assert not any(out[i] for i in plain)


def test_rule_is_unsure_beside_a_key():
    token = hexes(8005)
    assert secrets.rule_label(token, " commit ") == 0 and secrets.rule_label(token, 'token = "') == 1
    for before, after in (("Authorization: Bearer ", ""), ("auth token ", ""), ("https://", "@host"), ("", " token")):
        assert secrets.rule_label(token, before, after) is None


def test_trees_vote_as_the_forest_does(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    data = spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], "label double, x array<double>")
    forest = RandomForestClassifier(numTrees=7, maxDepth=5, seed=1).fit(
        data.select("label", array_to_vector("x").alias("features")).coalesce(1))
    model = secrets.SecretModel(None, secrets._trees(forest.toDebugString))
    from pyspark.ml.linalg import Vectors
    for row, p in zip(x[:60], model.probability(x[:60])):
        votes = [t.predict(Vectors.dense(row)) for t in forest.trees]
        assert p == pytest.approx(sum(votes) / 7)


def test_statistics_cover_all_documents(spark):
    rows = EDGE_ROWS + [(30, "abab " * 10)]
    stats = secrets.statistics(docs(spark, rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    blob = [(t or "").encode() for _, t in rows]
    n = sum(b.count(b"ab") for b in blob)
    total = sum(1 for b in blob for i in range(len(b) - 1) if b[i:i + 1] == b"a" and b[i + 1] < 128)
    # texts are joined by newlines inside a batch, so a final 'a' may add one pair each
    assert stats.transitions[ord("a"), ord("b")] == pytest.approx(np.log((n + 1) / (total + 128)), abs=0.01)
    assert {"abab", "lorem", "twice"} <= stats.dictionary


def test_redact_and_edges(spark, model):
    rows = EDGE_ROWS + [(60, f'é漢 token = "{hexes(1)}" and secret: "{hexes(2)}"!')]
    frame = docs(spark, rows).withColumn("secrets", F.lit("mine"))
    out = secrets.scan(frame, model)
    assert out.count() == len(rows)
    text = {r.doc_id: r.t for r in out.select("doc_id", secrets.redact(F.col("text"), F.col("secrets")).alias("t")).collect()}
    assert text[60] == 'é漢 token = "[SECRET]" and secret: "[SECRET]"!'
    assert text[1] is None and text[2] == "" and text[6] == EDGE_ROWS[7][1] and text[7] == EDGE_ROWS[8][1]
    assert secrets.scan(frame.limit(0), model).count() == 0
    assert secrets.fit(docs(spark, [])).trees


def test_dictionary_is_filled_to_its_bound(spark, monkeypatch):
    """The most frequent words are in whole; of the power of two that the bound cuts, as many as fit."""
    monkeypatch.setattr(secrets, "DICTIONARY_WORDS", 12)
    rows = [(k, " ".join([f"often{c}"[:10] for c in "abcd"] * 8 + [f"seldom{c}" for c in "abcdefghijklmnopqrst"])) for k in range(3)]
    d = secrets.statistics(docs(spark, rows).select("doc_id", "text")).dictionary
    assert {f"often{c}" for c in "abcd"} < d and len(d) == 12 and sum(w.startswith("seldom") for w in d) == 8


def test_findings_are_bounded_exactly_and_of_any_length(spark):
    rows = [(k, f'token = "{"aB3cD5eF7gH9" * 60}{k}x9"' if k % 10 == 0 else f'password = "q{k}Zr8Lm{k * 7}Wx4"') for k in range(300)]
    found = secrets.labelled_findings(docs(spark, rows).select("doc_id", "text"), per_class=20).collect()
    assert sum(r.label == 1 for r in found) == 20 and len({r.token for r in found}) == len(found)
    every = secrets.labelled_findings(docs(spark, rows).select("doc_id", "text"), per_class=1000).collect()
    assert max(len(r.token) for r in every) > 600 and sum(r.label == 1 for r in every) >= 290
