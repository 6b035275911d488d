"""Byte BPE: ids equal the library's, and decoding is an exact round trip."""

import base64

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from drawlake.llm import bpe
from tests.llm.util import EDGE_ROWS, docs, prose

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")
VOCAB = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCAB, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(spark, library, rows):
    ids = bpe.encode(docs(spark, rows), VOCAB, public.PATTERN)
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in bpe.decode(ids, VOCAB).collect()), key=str)
    assert got == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=str)


def test_equals_the_library(spark, library):
    odd = [" a", "a ", "  a  b ", "a\n b", "a \nb", "\n\n", "\t x", "don't I'LL 'tis ''s", "a b  c\x1c d\x85e",
           "a  b a b", "one\n\ntwo  three \n four five\tsix", " ", "", "12.50€ <|endoftext|>", "x" * 3000]
    check(spark, library, EDGE_ROWS + [(100 + k, t) for k, t in enumerate(odd)])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=40))
def test_any_text(spark, library, texts):
    check(spark, library, list(enumerate(texts)))


def test_several_blocks(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_DOCS", 3)
    check(spark, library, [(k % 9, prose(k, 40)) for k in range(25)])


def test_blocks_without_answers_are_encoded_in_place(library):
    find_all = __import__("regex").compile(public.PATTERN).findall
    block = bpe._Block(find_all)
    block.add(1, "some words here")
    (key, _, positions), = block.finish(0, 7, True)
    words = block.finish(0, 7, False)
    assert {k for k, _, _ in words} == {key} and key != block.finish(1, 7, True)[0][0]
    assert bpe._unpack(positions)[1].tolist() == [3]


def test_decimal_ids(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [7]), (4, [50, 0, 1234])], "doc_id long, ids array<int>")
    got = bpe.decode(frame, VOCAB, decimal_col="d").orderBy("doc_id").collect()
    assert [r.d for r in got] == [None, b"", b"7", b"50,0,1234"]


def test_empty_and_bad_ids(spark):
    assert bpe.decode(bpe.encode(docs(spark, []), VOCAB, public.PATTERN), VOCAB).count() == 0
    frame = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(frame, VOCAB).orderBy("doc_id").collect()] == [None, b""]
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, [10 ** 6])], "doc_id long, ids array<int>"), VOCAB).collect()
