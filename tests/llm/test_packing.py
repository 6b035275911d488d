"""Packing: ids equal the library's, placing respects every capacity, few sequences."""

import zlib

import numpy as np
import pandas as pd
import pytest

from drawlake.llm.packing import best_fit_bins, pack_best_fit, token_pieces
from tests.llm.util import EDGE_ROWS, docs, prose

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
VOCAB = public.path("word_bpe_49k.json")


@pytest.mark.parametrize("as_text", [False, True])
def test_pieces_equal_the_library(spark, as_text):
    tokenizer = tokenizers.Tokenizer.from_file(VOCAB)
    tokenizer.encode_special_tokens = as_text
    rows = EDGE_ROWS + [(10, "I'll say \"it's\" 12.5%... <|endoftext|> A\x1cB a b ΣΑΣ ὈΔΥΣΣΕΎΣ İ"), (11, "x" * 5000),
                        (12, "a<|endoftext|>b"), (13, "<|startoftext|>hi <|EndOfText|> <|end"), (14, "É,é--ñ² ª «ß» na\xadme")]
    got = token_pieces(docs(spark, rows), VOCAB, max_tokens=64, encode_special_tokens=as_text).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k // 64, k, len(ids[k:k + 64]), zlib.crc32(np.array(ids[k:k + 64], "<u4").tobytes()))
                 for k in range(0, len(ids), 64)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_bins_respect_all_capacities(rule):
    rng = np.random.default_rng(3)
    length = rng.integers(1, 100, 600)
    demand = np.stack([length, np.ones_like(length), length ** 2], axis=1)
    capacity = np.array([100, 7, 6000])
    demand = demand[demand[:, 2] <= 6000]
    bins = best_fit_bins(demand, capacity, np.array([1.0, 0.2, 0.5]), rule)
    used = np.zeros((bins.max() + 1, 3), dtype=int)
    np.add.at(used, bins, demand)
    assert (used <= capacity).all() and (used[:, 1] > 0).all()
    with pytest.raises(ValueError):
        best_fit_bins(np.array([[101, 1, 1]]), capacity, np.ones(3))


def brute_best_fit(lengths, cap):
    """Best-fit decreasing on one capacity, by definition."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(cap - n)
    return len(room)


def test_as_few_sequences_as_best_fit(spark):
    lengths = [int(x) for x in np.random.default_rng(1).integers(1, 1000, 800)] + [1000] * 5
    items = spark.createDataFrame([(k, n, "y") for k, n in enumerate(lengths)], "doc_id long, length long, offset string")
    out = pack_best_fit(items, 1000).toPandas()
    assert len(out) == 805 and out.sequence_id.nunique() <= brute_best_fit(lengths, 1000)
    out = out.sort_values(["sequence_id", "offset"])
    by = out.groupby("sequence_id").length
    assert (by.sum() <= 1000).all() and ((by.cumsum() - out.length) == out.offset).all()
    many = pack_best_fit(items, 1000, group_rows=100).select("sequence_id").distinct().count()
    assert many <= 1.05 * brute_best_fit(lengths, 1000)


def test_other_capacities(spark):
    items = spark.createDataFrame([(k, 10) for k in range(40)], "doc_id long, length long")
    assert pack_best_fit(items, 100, max_documents=4).select("sequence_id").distinct().count() == 10
    assert pack_best_fit(items, 100, max_attention=500).select("sequence_id").distinct().count() == 8
    with pytest.raises(ValueError):
        pack_best_fit(items, 100, max_attention=50)


def test_edges(spark):
    assert pack_best_fit(spark.createDataFrame([], "doc_id long, length long")).count() == 0
    assert token_pieces(docs(spark, []), VOCAB).count() == 0
    for bad in (None, 0, 5000):
        with pytest.raises(ValueError):
            pack_best_fit(spark.createDataFrame([(1, bad)], "doc_id long, length long")).count()
    pieces = token_pieces(docs(spark, [(1, prose(1, 50))] * 3), VOCAB)
    packed = pack_best_fit(pieces).toPandas()
    assert len(packed) == 3 and packed.sequence_id.nunique() == 1 and packed.offset.nunique() == 3
    assert isinstance(packed, pd.DataFrame)
