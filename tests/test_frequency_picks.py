import pandas as pd
from pyspark.sql import functions as F

from drawlake.operators.frequency import (
    frequency, frequency_matrix, frequency_share, recency, top_n_with_others,
)
from drawlake.operators.picks import (
    backtest_window_picks, pick_top_k, random_tickets, score_picks, ticket,
)
from drawlake.operators.reshape import to_long
from drawlake.operators.sequence import global_sequence
from drawlake.schemas import MAIN, NUMBER_COLUMNS, STAR
from tests.conftest import draws_df, random_draws


def _pdf(rows):
    cols = ["draw_number", "draw_date"] + list(NUMBER_COLUMNS)
    return pd.DataFrame(rows, columns=cols)


def test_frequency_matches_value_counts(spark):
    rows = random_draws(200, repeat_every=9, null_every=5)
    got = {(r.pool, r.number): r.frequency for r in frequency(to_long(draws_df(spark, rows))).collect()}
    p = _pdf(rows)
    main = pd.concat([p[c] for c in MAIN.columns]).value_counts()
    star = pd.concat([p[c] for c in STAR.columns]).dropna().astype(int).value_counts()
    assert {k[1]: v for k, v in got.items() if k[0] == "main"} == main.to_dict()
    assert {k[1]: v for k, v in got.items() if k[0] == "star"} == star.to_dict()


def test_share_sums_to_100(spark):
    rows = random_draws(50)
    shares = frequency_share(frequency(to_long(draws_df(spark, rows))), decimals=None).collect()
    for pool in ("main", "star"):
        assert abs(sum(r.share_pct for r in shares if r.pool == pool) - 100.0) < 1e-9


def test_top_n_with_others_ties_and_small_groups(spark):
    counts = spark.createDataFrame(
        [("main", n, c) for n, c in [(1, 5), (2, 5), (3, 5), (4, 1), (5, 1)]] + [("star", 1, 9), ("star", 2, 1)],
        "pool string, number int, frequency long")
    out = {(r.pool, r.label): r.frequency for r in top_n_with_others(counts, 2).collect()}
    # ties resolve to the smaller numbers; the rest folds into Others
    assert out[("main", "1")] == 5 and out[("main", "2")] == 5 and out[("main", "Others")] == 7
    # a group with no more than n numbers gets no Others row
    assert ("star", "Others") not in out


def test_frequency_matrix_zero_fill(spark):
    df = draws_df(spark, [(1, "2020-01-01", 1, 2, 3, 4, 5, 1, 2), (2, "2021-01-01", 1, 2, 3, 4, 5, 3, 3)])
    m = frequency_matrix(to_long(df, keep=["draw_date"]), STAR, F.year("draw_date")).orderBy("year").collect()
    assert [r.n_3 for r in m] == [0, 2] and [r.n_12 for r in m] == [0, 0]
    assert len(m[0]) == 13


def test_recency_brute_force_and_never_seen(spark):
    rows = random_draws(40)
    df = draws_df(spark, rows)
    sd = global_sequence(df, ["draw_date", "draw_number"])
    got = {(r.pool, r.number): r.draws_since for r in recency(sd).collect()}
    p = _pdf(rows).sort_values(["draw_date", "draw_number"], ascending=False).reset_index(drop=True)
    for pool in (MAIN, STAR):
        for n in range(pool.lo, pool.hi + 1):
            hit = [i for i in range(len(p)) if n in p.loc[i, list(pool.columns)].tolist()]
            want = hit[0] if hit else len(p)
            assert got[(pool.name, n)] == want


def test_pick_top_k_tie_break_and_least(spark):
    stats = spark.createDataFrame([("main", n, 3) for n in range(1, 8)] + [("star", 4, 1), ("star", 2, 1), ("star", 9, 5)],
                                  "pool string, number int, frequency long")
    most_df = pick_top_k(stats, "frequency")
    most = most_df.collect()
    assert sorted(r.number for r in most if r.pool == "main") == [1, 2, 3, 4, 5]
    assert sorted(r.number for r in most if r.pool == "star") == [2, 9]
    least = pick_top_k(stats, "frequency", largest=False).collect()
    assert sorted(r.number for r in least if r.pool == "star") == [2, 4]
    t = {r.pool: r.numbers for r in ticket(most_df).collect()}
    assert t["main"] == [1, 2, 3, 4, 5]


def test_random_tickets_invariants(spark):
    ids = spark.range(500).withColumnRenamed("id", "ticket_id")
    a = random_tickets(ids, seed=1).collect()
    b = random_tickets(ids.repartition(7), seed=1).collect()
    assert {r.ticket_id: (r.main_numbers, r.star_numbers) for r in a} == \
           {r.ticket_id: (r.main_numbers, r.star_numbers) for r in b}
    for r in a:
        assert len(set(r.main_numbers)) == 5 and r.main_numbers == sorted(r.main_numbers)
        assert all(1 <= x <= 50 for x in r.main_numbers) and all(1 <= x <= 12 for x in r.star_numbers)
        assert len(set(r.star_numbers)) == 2
    c = random_tickets(ids, seed=2).collect()
    assert [r.main_numbers for r in a] != [r.main_numbers for r in c]


def test_score_picks(spark):
    draws = draws_df(spark, [(1, "2021-01-01", 1, 2, 3, 4, 5, 1, 2)])
    picks = spark.createDataFrame([(1, [1, 2, 10, 11, 12], [2, 3])], "draw_number long, main_numbers array<int>, star_numbers array<int>")
    r = score_picks(picks, draws, "draw_number").first()
    assert r.main_matches == 2 and r.star_matches == 1


def test_backtest_matches_brute_force(spark):
    rows = random_draws(80, repeat_every=7)
    sd = global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"])
    got = {r.seq: (r.main_matches, r.star_matches) for r in backtest_window_picks(sd).collect()}
    p = _pdf(rows).sort_values(["draw_date", "draw_number"]).reset_index(drop=True)
    for i in range(20, len(p)):
        hist = p.iloc[i - 20:i]
        res = []
        for pool, k in ((MAIN, 5), (STAR, 2)):
            vc = pd.concat([hist[c] for c in pool.columns]).value_counts()
            ranked = sorted(range(pool.lo, pool.hi + 1), key=lambda n: (-vc.get(n, 0), n))[:k]
            res.append(len(set(ranked) & set(p.loc[i, list(pool.columns)].tolist())))
        assert got[i + 1] == tuple(res)
    assert len(got) == len(p) - 20
