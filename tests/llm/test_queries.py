"""The registered queries themselves, at sf0.001, against brute force (op5, op6, op11 and op13 run against SQL elsewhere)."""

import base64
import hashlib
import os
import zlib
from array import array

import numpy as np
import pyarrow.parquet as pq
import pytest

from drawlake.llm import queries
from tests.llm import test_minhash, test_pii, test_quality

SF = "/root/testdata/sf0.001"
if not os.path.isdir(SF):
    pytest.skip("test data not present", allow_module_level=True)
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in t}


def rows(spark, name, *columns):
    got = queries.QUERIES[name](spark, SF)
    assert set(columns) <= set(got.columns)
    return got.select(*columns).collect()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1(spark, texts):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    got = rows(spark, "op1_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    want = set()
    for i, t in texts.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        want |= {(i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(array("I", ids[k:k + 4096]).tobytes())) for k in range(0, len(ids), 4096)}
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    placed = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert placed.get(r.sequence_id, 0) == r.offset
        placed[r.sequence_id] = r.offset + r.length
    assert max(placed.values()) <= 4096
    assert len(placed) <= 1.02 * -(-sum(r.length for r in got) // 4096) + 1


def test_op2(spark, texts):
    got = rows(spark, "op2_toxicity", "doc_id", "held_out", "score", "predicted")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op3(spark, texts):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, "op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    ids = {i: library.encode_ordinary(t) for i, t in texts.items()}
    assert {tuple(r) for r in got} == {(i, len(ids[i]), sha(",".join(map(str, ids[i]))), sha(t)) for i, t in texts.items()}


def test_op4(spark, texts):
    got = rows(spark, "op4_minhash_dedup", "doc_id", "n_shingles", "component_id", "kept")
    assert {tuple(r) for r in got} == set(test_minhash.components(list(texts.items()), 2))


def test_op7(spark, texts):
    got = rows(spark, "op7_sharding", "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    load, last = {}, (-1, -1)
    for k, r in enumerate(sorted(got, key=lambda r: (r.shard, r.slot))):
        assert 0 <= r.shard < 40 and r.slot == (last[1] + 1 if r.shard == last[0] else 0)
        assert k == 0 or r.doc_id > before  # contiguous by doc_id  # noqa: F821
        last, before = (r.shard, r.slot), r.doc_id
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert max(load.values()) - sum(load.values()) / 40 <= max(r.size for r in got)


def test_op8(spark, texts):
    got = rows(spark, "op8_quality_rules", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {tuple(r)[:7] for r in got} == {(i, *test_quality.base(t)) for i, t in texts.items()}
    assert all(not (r.kept and r.base_failed) for r in got) and any(r.kept for r in got)


def test_op9(spark, texts):
    got = {r.doc_id: r for r in rows(spark, "op9_personal_data", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
    assert set(got) == set(texts)
    for i, t in texts.items():
        own = test_pii.base(t)
        told = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in own)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[0] == k for s in own) for k in ("email", "ip", "card", "phone")]
        assert got[i].base_sha256 == sha(told)
        assert got[i].spans == told or got[i].spans.startswith(f"{told}," if told else "term:")


def test_op10(spark, texts):
    from drawlake.llm import secrets
    for r in rows(spark, "op10_secret_scan", "doc_id", "n_candidates", "n_secrets", "spans"):
        every = {f"{a}:{b}" for a, b in secrets.candidates(texts[r.doc_id])}
        kept = r.spans.split(",") if r.spans else []
        assert r.n_candidates == len(every) and r.n_secrets == len(kept) and set(kept) <= every


def test_op12(spark):
    got = rows(spark, "op12_whitening", "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    x = {r["vec_id"]: np.floor(64 * np.array(r["embedding"], dtype=float)).astype(np.int64) + 1_000_000
         for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist() if r["embedding"] is not None}
    fit = np.array(sorted({tuple(v.tolist()) for v in x.values()}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    value = np.linalg.eigvalsh((fit - s / n).T @ (fit - s / n) / n)[::-1]
    assert len(got) == 16 * len(x) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    away = {i: int(((n * v - s).astype(object) ** 2).sum()) for i, v in x.items()}
    assert all(r.deviation == away[r.vec_id] and abs(r.explained / (value[r.component - 1] / value.sum()) - 1) < 1e-8 for r in got)
