"""Sharding: contiguous, balanced, gapless."""

import zlib

import pytest

from drawlake.llm.sharding import document_shards, shard_by_bytes
from tests.llm.util import EDGE_ROWS, docs, prose


def test_balanced_and_contiguous(spark):
    rows = [(k // 2, prose(k, 5 + k % 60)) for k in range(900)] + [(7, "same")] * 300
    out = document_shards(docs(spark, rows), 12).toPandas()
    assert len(out) == len(rows)
    total, biggest = out["size"].sum(), out["size"].max()
    by = out.groupby("shard")
    assert len(by) == 12 and ((by["size"].sum() - total / 12).abs() <= biggest).all()
    for _, g in by:
        assert sorted(g.slot) == list(range(len(g)))
    lo, hi = by.doc_id.min(), by.doc_id.max()
    assert (hi.values[:-1] <= lo.values[1:]).all()  # contiguous in the order of ids
    want = sorted((i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in rows)
    assert sorted(zip(out.doc_id, out["size"], out.text_crc32)) == want


def test_edges(spark):
    out = document_shards(docs(spark, EDGE_ROWS), 40).collect()
    assert len(out) == len(EDGE_ROWS) and all(0 <= r.shard < 40 for r in out)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {(r.size, r.text_crc32) for r in out if r.doc_id in (1, 2)} == {(16, 0)}
    assert document_shards(docs(spark, []), 40).count() == 0
    zero = spark.createDataFrame([(1, 0), (2, 0)], "k long, n long")
    assert {(r.shard, r.slot) for r in shard_by_bytes(zero, 3, "n", ["k"]).collect()} == {(0, 0), (0, 1)}
    for bad in (None, -1):
        with pytest.raises(Exception):
            shard_by_bytes(spark.createDataFrame([(1, bad)], "k long, n long"), 3, "n", ["k"]).count()
