"""Distribution, recency and pick queries over the derived draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawlake.operators.frequency import (
    frequency, frequency_matrix, frequency_share, recency, top_n_with_others, top_values,
)
from drawlake.operators.picks import pick_top_k, sample_numbers
from drawlake.operators.reshape import densify, to_long
from drawlake.plans.catalog import register
from drawlake.plans.derived import DERIVED_ORDER, load_draws, sequenced_draws, table, with_draws
from drawlake.schemas import MAIN, STAR


@register("number_frequency", with_draws("""
SELECT pool, number, count(*) AS frequency FROM lg GROUP BY pool, number
"""))
def number_frequency(spark, sf_dir):
    return frequency(to_long(load_draws(spark, sf_dir)))


@register("frequency_share", with_draws("""
SELECT pool, number, frequency, frequency * 100.0 / sum(frequency) OVER (PARTITION BY pool) AS share_pct
FROM (SELECT pool, number, count(*) AS frequency FROM lg GROUP BY pool, number)
"""))
def frequency_share_q(spark, sf_dir):
    return frequency_share(frequency(to_long(load_draws(spark, sf_dir))))


@register("top15_with_others", with_draws("""
SELECT year, pool, label, CAST(sum(frequency) AS BIGINT) AS frequency FROM (
  SELECT year, pool, frequency,
         CASE WHEN row_number() OVER (PARTITION BY year, pool ORDER BY frequency DESC, number) <= 15
              THEN CAST(number AS VARCHAR) ELSE 'Others' END AS label
  FROM (SELECT CAST(year(draw_date) AS INTEGER) AS year, pool, number, count(*) AS frequency
        FROM lg WHERE pool = 'main' GROUP BY 1, 2, 3))
GROUP BY year, pool, label
"""))
def top15_with_others(spark, sf_dir):
    long_df = to_long(load_draws(spark, sf_dir), [MAIN], keep=[F.year("draw_date").alias("year")])
    return top_n_with_others(frequency(long_df, by=["year"]), 15, by=["year"])


@register("yearly_star_share", with_draws("""
SELECT year, pool, number, frequency,
       frequency * 100.0 / sum(frequency) OVER (PARTITION BY year, pool) AS share_pct
FROM (SELECT CAST(year(draw_date) AS INTEGER) AS year, pool, number, count(*) AS frequency
      FROM lg WHERE pool = 'star' GROUP BY 1, 2, 3)
"""))
def yearly_star_share(spark, sf_dir):
    """Per-year star distribution with shares (the per-year pie table, no top-N)."""
    long_df = to_long(load_draws(spark, sf_dir), [STAR], keep=[F.year("draw_date").alias("year")])
    return frequency_share(frequency(long_df, by=["year"]), by=["year"])


@register("overall_top15_with_others", with_draws("""
SELECT pool, label, CAST(sum(frequency) AS BIGINT) AS frequency FROM (
  SELECT pool, frequency,
         CASE WHEN row_number() OVER (PARTITION BY pool ORDER BY frequency DESC, number) <= 15
              THEN CAST(number AS VARCHAR) ELSE 'Others' END AS label
  FROM (SELECT pool, number, count(*) AS frequency FROM lg GROUP BY 1, 2))
GROUP BY pool, label
"""))
def overall_top15_with_others(spark, sf_dir):
    return top_n_with_others(frequency(to_long(load_draws(spark, sf_dir))), 15)


@register("parts_by_flag_share", """
WITH c AS (SELECT l_returnflag, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_partkey) AS rk,
             sum(n) OVER (PARTITION BY l_returnflag) AS total FROM c)
SELECT l_returnflag, CASE WHEN rk <= 25 THEN CAST(l_partkey AS VARCHAR) ELSE 'Others' END AS label, rk > 25 AS is_other,
       CAST(sum(n) AS BIGINT) AS frequency, sum(n) * 100.0 / any_value(total) AS share_pct
FROM r GROUP BY 1, 2, 3
""")
def parts_by_flag_share(spark, sf_dir):
    """Per return flag the 25 parts with most lines, all others together, with shares (O39, O56 over an open domain)."""
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_partkey").agg(F.count(F.lit(1)).alias("frequency"))
    return top_values(counts, "l_partkey", 25, by=["l_returnflag"])


@register("order_samples", """
WITH d AS (SELECT o_orderkey, i, ('0x' || substr(md5('42:' || o_orderkey || ':' || i), 1, 15))::BIGINT AS h
           FROM orders, range(1, 5) t(i)),
p AS (SELECT o_orderkey, max(h % 999997 + 1) FILTER (WHERE i = 1) AS a1, max(h % 999998 + 1) FILTER (WHERE i = 2) AS a2,
             max(h % 999999 + 1) FILTER (WHERE i = 3) AS a3, max(h % 1000000 + 1) FILTER (WHERE i = 4) AS a4 FROM d GROUP BY 1),
q AS (SELECT *, CASE WHEN a2 = a1 THEN 999998 ELSE a2 END AS b2 FROM p),
s AS (SELECT *, CASE WHEN a3 IN (a1, b2) THEN 999999 ELSE a3 END AS b3 FROM q),
t AS (SELECT *, CASE WHEN a4 IN (a1, b2, b3) THEN 1000000 ELSE a4 END AS b4 FROM s)
SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, list_sort([a1, b2, b3, b4])[pos + 1] AS number FROM t, range(0, 4) x(pos)
""")
def order_samples(spark, sf_dir):
    """Four different numbers of a million for every order, in four steps each."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return sample_numbers(orders, "o_orderkey", 1, 1_000_000, 4).select("o_orderkey", F.posexplode("numbers").alias("pos", "number"))


def _matrix_sql(pool: str, hi: int) -> str:
    cols = ",\n  ".join(f"count(*) FILTER (WHERE number = {n}) AS n_{n}" for n in range(1, hi + 1))
    return with_draws(f"""
SELECT CAST(year(draw_date) AS INTEGER) AS year,
  {cols}
FROM lg WHERE pool = '{pool}' GROUP BY 1
""")


@register("yearly_matrix_stars", _matrix_sql("star", STAR.hi))
def yearly_matrix_stars(spark, sf_dir):
    return frequency_matrix(to_long(load_draws(spark, sf_dir), [STAR], keep=["draw_date"]),
                            STAR, F.year("draw_date"))


@register("yearly_matrix_main", _matrix_sql("main", MAIN.hi))
def yearly_matrix_main(spark, sf_dir):
    return frequency_matrix(to_long(load_draws(spark, sf_dir), [MAIN], keep=["draw_date"]),
                            MAIN, F.year("draw_date"))


_RECENCY_SQL = """
rec AS (
  SELECT dom.pool, dom.number,
         coalesce((SELECT count(*) FROM sd) - l.last_seq, (SELECT count(*) FROM sd)) AS draws_since
  FROM dom LEFT JOIN (SELECT pool, number, max(seq) AS last_seq FROM lg GROUP BY 1, 2) l
    ON dom.pool = l.pool AND dom.number = l.number)
"""


@register("recency_overdue", with_draws("SELECT pool, number, draws_since FROM rec", _RECENCY_SQL))
def recency_overdue(spark, sf_dir):
    return recency(load_draws(spark, sf_dir), DERIVED_ORDER)


def _pick_sql(stat_sql: str, stat: str, direction: str) -> str:
    return f"""
SELECT pool, pick_rank, number, {stat} FROM (
  SELECT pool, number, {stat},
         CAST(row_number() OVER (PARTITION BY pool ORDER BY {stat} {direction}, number) AS INTEGER) AS pick_rank
  FROM ({stat_sql}))
WHERE pick_rank <= CASE pool WHEN 'main' THEN 5 WHEN 'star' THEN 2 ELSE 0 END
"""


_FREQ = "SELECT pool, number, count(*) AS frequency FROM lg GROUP BY pool, number"


@register("picks_most_frequent", with_draws(_pick_sql(_FREQ, "frequency", "DESC")))
def picks_most_frequent(spark, sf_dir):
    return pick_top_k(frequency(to_long(load_draws(spark, sf_dir))), "frequency", largest=True)


@register("picks_least_frequent", with_draws(_pick_sql(_FREQ, "frequency", "ASC")))
def picks_least_frequent(spark, sf_dir):
    return pick_top_k(frequency(to_long(load_draws(spark, sf_dir))), "frequency", largest=False)


_FREQ_DOMAIN = """
SELECT dom.pool, dom.number, coalesce(c.frequency, 0) AS frequency
FROM dom LEFT JOIN (SELECT pool, number, count(*) AS frequency FROM lg GROUP BY pool, number) c
  ON dom.pool = c.pool AND dom.number = c.number
"""


@register("picks_least_frequent_domain", with_draws(_pick_sql(_FREQ_DOMAIN, "frequency", "ASC")))
def picks_least_frequent_domain(spark, sf_dir):
    """Least frequent picks counting never-drawn numbers as zero (D7 ``domain`` option)."""
    counts = densify(frequency(to_long(load_draws(spark, sf_dir))), fill={"frequency": 0})
    return pick_top_k(counts, "frequency", largest=False)


@register("picks_most_overdue", with_draws(_pick_sql("SELECT * FROM rec", "draws_since", "DESC"), _RECENCY_SQL))
def picks_most_overdue(spark, sf_dir):
    return pick_top_k(recency(load_draws(spark, sf_dir), DERIVED_ORDER), "draws_since", largest=True)


@register("draw_sequence", with_draws("""
SELECT seq, draw_number, draw_date, part FROM sd
"""))
def draw_sequence(spark, sf_dir):
    return sequenced_draws(spark, sf_dir).select("seq", "draw_number", "draw_date", "part")
