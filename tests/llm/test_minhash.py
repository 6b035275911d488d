"""Near-duplicates against all pairs of exact sets."""

import random
from itertools import combinations

import pytest

from drawlake.llm import minhash
from tests.llm.util import EDGE_ROWS, docs, prose


def sets(rows, size):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        out.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
    return out


def components(rows, size, percent=80):
    """Smallest id reachable, per row."""
    s = sets(rows, size)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if rows[a][0] is None or rows[b][0] is None or not s[a] or not s[b]:
            continue
        if 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s[k]), None if i is None else least[find(k)], i is not None and least[find(k)] == i)
            for k, (i, _) in enumerate(rows)]


def check(spark, rows, size):
    got = minhash.near_duplicates(docs(spark, rows), size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == \
        sorted(components(rows, size), key=str)


def altered(text, rnd, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("size", [2, 5])
def test_equals_all_pairs(spark, size):
    rnd = random.Random(size)
    rows = []
    for k in range(12):
        base = prose(k, 120)
        rows.append((len(rows), base))
        for n in (0, 1, 2, 3, 4, 6, 9, 14, 20):
            rows.append((len(rows), altered(base, rnd, n)))
    # a chain: each text near the next only
    chain = prose(99, 100)
    for _ in range(15):
        rows.append((len(rows), chain := altered(chain, rnd, 3)))
    rnd.shuffle(rows)
    check(spark, rows, size)


def test_edges(spark):
    check(spark, EDGE_ROWS + [(20, "ONE"), (21, "Null Id"), (22, "a b"), (23, "A  B\n")], 2)
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    only = [(3, prose(1, 30))]
    check(spark, only, 2)


def test_second_round_finds_links_beside_the_smallest_class(spark, monkeypatch):
    """Classes of one bucket that are far from its smallest but near each other."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rnd = random.Random(5)
    base = prose(7, 200)
    rows = [(k, altered(base, rnd, 14)) for k in range(30)]
    rows += [(100 + k, altered(t, rnd, 2)) for k, (_, t) in enumerate(rows[5:25])]
    check(spark, rows, 2)


def test_drop_keeps_one_of_each_group(spark):
    base = prose(3, 80)
    rows = [(1, base), (2, base), (2, base), (3, None), (4, ""), (None, base), (None, base), (5, "other words here"),
            (9, prose(4, 80))]
    kept = minhash.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, None, None, 5, 9], key=str)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] \
        + [(500, 500 + k) for k in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in minhash.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}
    assert minhash.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
