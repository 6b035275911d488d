"""Property tests: operators vs a plain Python form over random draw histories."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from drawlake.operators.frequency import recency
from drawlake.operators.features import window_stats
from drawlake.operators.sequence import global_sequence
from tests.conftest import draws_df
from tests.test_windows import DOMAIN, ordered, window_table

_draw = st.tuples(st.lists(st.integers(1, 50), min_size=5, max_size=5),
                  st.lists(st.one_of(st.none(), st.integers(1, 12)), min_size=2, max_size=2),
                  st.integers(0, 3))


def _rows(draws):
    out, day = [], dt.date(2010, 1, 1)
    for i, (balls, stars, gap) in enumerate(draws):
        day = day + dt.timedelta(days=gap)          # gap 0 repeats a date
        out.append((1000 - i, day.isoformat(), *balls, *stars))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_draw, min_size=0, max_size=40), st.integers(1, 6))
def test_window_stats_property(spark, draws, window):
    rows = _rows(draws)
    sd = global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"], num_partitions=3)
    got = {}
    for r in window_stats(sd, window=window, lags=1, chunk=5).collect():
        got.setdefault(r.seq, {})[(r.pool, r.number)] = (r.frequency, r.recency)
    assert got == window_table(ordered(rows), window)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_draw, min_size=0, max_size=30))
def test_recency_property(spark, draws):
    rows = _rows(draws)
    sd = global_sequence(draws_df(spark, rows), ["draw_date", "draw_number"], num_partitions=2)
    got = {(r.pool, r.number): r.draws_since for r in recency(sd).collect()}
    assert got == {(r.pool, r.number): r.draws_since
                   for r in recency(draws_df(spark, rows), ["draw_date", "draw_number"]).collect()}
    newest_first = ordered(rows)[::-1]
    for c in DOMAIN:
        assert got[c] == next((i for i, picks in enumerate(newest_first) if c in picks), len(newest_first))
