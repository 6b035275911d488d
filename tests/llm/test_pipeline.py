"""The pipeline: each stage against a brute-force form of its decision, on its own input."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from drawlake.llm import quality, secrets, toxicity
from drawlake.session import write_and_reread
from tests.llm.test_minhash import components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(write_and_reread(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == \
        ["quality_rules", "toxicity", "minhash_near_dedup", "secret_scan", "best_fit_packing"]
    assert all(s.columns == COLUMNS for s in stages[:5])


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(stages[0], quality.fit(stages[0], labels)).collect()
    assert set(rows(stages[1])) == {r.doc_id for r in judged if r.quality_rules.kept}
    clean = labels.where("quality = 1").join(stages[0], "doc_id").collect()
    passed = rows(stages[1])
    base = {r.doc_id: r.quality_rules.base_failed for r in judged}
    assert all(r.doc_id in passed for r in clean if not base[r.doc_id])


def test_toxicity_stage(spark, stages):
    model = toxicity.fit(stages[1], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {i for i, r in rows(stages[1]).items() if model.probabilities([r.text or ""])[0] < 0.5}
    assert set(rows(stages[2])) == want


def test_dedup_stage(stages):
    docs = [(r.doc_id, r.text) for r in stages[2].collect()]
    want = {i for (i, _, _, kept), (_, t) in zip(components(docs, 5), docs) if kept or not (t or "").split()}
    assert set(rows(stages[3])) == want


def test_secret_stage(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    model = secrets.fit(stages[3])
    changed = 0
    for i, r in before.items():
        spans = [s for s in secrets.candidates(r.text)
                 if model.probability(_features(model, r.text, s))[0] > 0.5]
        text = r.text
        for s, e in reversed(spans):
            text = text[:s] + "[SECRET]" + text[e:]
        assert after[i].text == text and after[i].n_chars == len(text)
        changed += bool(spans)
    assert all((after[i].lang, after[i].source) == (before[i].lang, before[i].source) for i in before)


def _features(model, text, span):
    import numpy as np
    return np.array([secrets.describe(*secrets._beside(text, *span), model.stats)])


def test_packing_stage(spark, stages):
    packed = stages[5].toPandas()
    assert set(packed.doc_id) == set(rows(stages[4]))
    by = packed.groupby("sequence_id").length.sum()
    assert by.max() <= 4096 and len(by) <= math.ceil(packed.length.sum() / 4096) + 1
    assert corpus_pipeline.run(spark, SF).select(F.sum("length")).first()[0] == packed.length.sum()


def test_awkward_documents(spark):
    frame = spark.createDataFrame(
        [(1, None, None, None, None), (None, "x y", "en", "a", 3), (2, "", "en", "a", 0), (2, "", "en", "a", 0)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, SF).count() >= 0, name
        assert stage(spark, frame.limit(0), SF).count() == 0, name
