import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from drawlake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="drawlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def draws_df(spark, rows):
    """rows: (draw_number, 'YYYY-MM-DD', b1..b5, s1, s2)."""
    import datetime as dt
    data = [(r[0], dt.date.fromisoformat(r[1]), *r[2:]) for r in rows]
    return spark.createDataFrame(
        data, "draw_number long, draw_date date, ball_1 int, ball_2 int, ball_3 int, ball_4 int, "
              "ball_5 int, lucky_star_1 int, lucky_star_2 int")


def random_draws(n, seed=7, null_every=0, repeat_every=0, unique_dates=False):
    import datetime as dt
    import random
    rnd = random.Random(seed)
    out = []
    base = dt.date(2004, 2, 13)
    for i in range(n):
        balls = sorted(rnd.sample(range(1, 51), 5))
        stars = sorted(rnd.sample(range(1, 13), 2))
        if repeat_every and i % repeat_every == 0:
            balls[1] = balls[0]          # repeated number inside one draw
        if null_every and i % null_every == 3:
            stars[1] = None              # null number
        # dates repeat (two draws share a date sometimes); draw_number breaks ties
        d = base + dt.timedelta(days=(i if unique_dates else i // 2) * 3)
        out.append((10_000 - i, d.isoformat(), *balls, *stars))
    return out
