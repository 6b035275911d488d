"""Decontamination against a plain search for word windows, and its edge cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from drawlake.llm.decontaminate import find, hit_spans
from tests.llm.util import EDGE_ROWS, docs, prose

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, items, size):
    """doc -> (words, hit words with positions, items), by comparing every window of every length."""
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text or ""))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    out = []
    for doc, text in rows:
        found = list(WORD.finditer(text or ""))
        w = [lower(m.group()) for m in found]
        hit, own = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    own |= windows[tuple(w[k:k + n])]
        out.append((doc, len(w), [(k, found[k].start(), found[k].end()) for k in sorted(hit)],
                    sorted(str(i) for i in own if i is not None)))
    return sorted(out, key=str)


def run(spark, rows, items, **kw):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, hits string")
    got = find(docs(spark, rows), bench, **kw)
    assert got.columns == ["doc_id", "n_words", "hits", "items"]
    return sorted([(r.doc_id, r.n_words, [tuple(h) for h in r.hits], list(r["items"])) for r in got.collect()], key=str)


@pytest.mark.parametrize("max_nodes", [4_000_000, 700])  # one automaton, and many of a few windows each
def test_equals_plain_search(spark, max_nodes):
    rnd = random.Random(5)
    letters = ["a", "B", "c", "é", "7"]
    items = [(k, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 9)))) for k in range(12)]
    rows = [(k, rnd.choice([" ", "--", "\n\x00"]).join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for k in range(60)]
    assert run(spark, rows, items, window=4, max_nodes=max_nodes) == brute(rows, items, 4)


@pytest.mark.parametrize("max_nodes", [4_000_000, 400])
def test_edges(spark, max_nodes):
    items = [(1, "Lorem, ipsum!"), (1, "twice THE same"), (2, ""), (3, None), (None, "null id"), (4, "ß 漢字"), (10, "ipsum dolor")]
    got = run(spark, EDGE_ROWS, items, window=2, max_nodes=max_nodes)
    assert got == brute(EDGE_ROWS, items, 2)
    by = {}
    for doc, n, hits, own in got:
        by.setdefault(doc, []).append((n, len(hits), own))
    assert by[1] == by[2] == by[3] == [(0, 0, [])] and by[None] == [(2, 2, [])]
    assert by[5] == [(3, 3, ["1"])] * 2 and by[7] == [(60_000, 60_000, ["1", "10"])]


def test_offsets_point_into_the_original(spark):
    text = "😀 Ünïcode -- What IS the\tcapital\nof “France”, then? Paris."
    bench = spark.createDataFrame([(1, "what is the capital of “france”")], "item_id int, text string")
    r = find(docs(spark, [(1, text)]), bench, window=3).select("hits", hit_spans(F.col("hits")).alias("s")).first()
    assert [text[a:b] for a, b in r.s] == ["What IS the\tcapital\nof “France”"]
    assert [text[h.start:h.end] for h in r.hits] == ["What", "IS", "the", "capital", "of", "“France”"]


def test_spans_stay_apart(spark):
    bench = spark.createDataFrame([(1, "a b"), (2, "x y")], "item_id int, text string")
    r = find(docs(spark, [(1, "a b c x y a b")]), bench, window=2).select(hit_spans(F.col("hits")).alias("s")).first()
    assert [tuple(s) for s in r.s] == [(0, 3), (6, 13)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert run(spark, [(1, "a b")], []) == [(1, 2, [], [])]
    assert find(docs(spark, []), none).collect() == []


def test_shared_passage_in_a_third_of_all_rows(spark):
    passage = prose(3, 30)
    rows = [(k, f"{prose(k, 20)} {passage if k % 3 == 0 else ''} {prose(-k - 1, 5)}") for k in range(300)]
    items = [(k, f"{passage} {prose(1000 + k, 12)}" if k % 3 == 0 else prose(2000 + k, 15)) for k in range(30)]
    got = run(spark, rows, items)
    assert got == brute(rows, items, 10)
    assert sum(bool(own) for *_, own in got) == 100 and max(len(own) for *_, own in got) == 10
