"""Draw-shaped view derived from lineitem x orders, and table loading.

Every five line items of an order (by line number, with further tie-break
columns) become one "draw", the rest of an order a short one: the quantities
give the main numbers, the ship months of the first two lines the stars, and
order key, date and the number of the five (``part``) identify it. Missing
numbers of a short draw are null. Every line item lands in exactly one draw.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drawlake.operators.sequence import global_sequence
from drawlake.schemas import ORDER_COLUMNS
from drawlake.session import write_and_reread

DERIVED_ORDER = (*ORDER_COLUMNS, "part")
_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived_draws(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """``draw_number, draw_date, part, ball_1..5, lucky_star_1..2``, one row per five lines of an order.

    One shuffle by order numbers the lines and groups them; only the join adds
    the orders-side exchange.
    """
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    at = F.row_number().over(w) - 1
    r = (lineitem.select("l_orderkey", *_LINE_ORDER[:-1], "l_extendedprice", "l_shipdate")
                 .withColumn("_at", at)
                 .select("l_orderkey", F.floor(F.col("_at") / 5).cast("int").alias("part"), (F.col("_at") % 5).alias("_pos"),
                         F.col("l_quantity").cast("int").alias("_q"),
                         F.month("l_shipdate").alias("_m")))
    aggs = [F.max(F.when(F.col("_pos") == i, F.col("_q"))).alias(f"ball_{i + 1}") for i in range(5)]
    aggs += [F.max(F.when(F.col("_pos") == i, F.col("_m"))).alias(f"lucky_star_{i + 1}") for i in (0, 1)]
    drawn = r.groupBy("l_orderkey", "part").agg(*aggs)
    o = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("draw_date"))
    return (drawn.join(o, drawn["l_orderkey"] == o["o_orderkey"])
                 .select(F.col("o_orderkey").alias("draw_number"), "draw_date", "part",
                         *[f"ball_{i}" for i in range(1, 6)], "lucky_star_1", "lucky_star_2"))


def load_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_draws(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def sequenced_draws(spark: SparkSession, sf_dir: str, seq_col: str = "seq") -> DataFrame:
    """Derived draws with a dense 1..N sequence ordered by (draw_date, draw_number, part).

    They are written first: the range bounds are sampled from what is numbered,
    which would otherwise be derived a second time for the sample.
    """
    return global_sequence(write_and_reread(load_draws(spark, sf_dir), "derived"), list(DERIVED_ORDER), seq_col)


# DuckDB form of the same derivation, shared by the oracle SQL strings.
DERIVED_DRAWS_CTE = """
r_ AS (
  SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS q, CAST(month(l_shipdate) AS INTEGER) AS m,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
  FROM lineitem),
dd AS (
  SELECT o_orderkey AS draw_number, CAST(o_orderdate AS DATE) AS draw_date, CAST((rn - 1) // 5 AS INTEGER) AS part,
         max(CASE WHEN rn % 5 = 1 THEN q END) AS ball_1, max(CASE WHEN rn % 5 = 2 THEN q END) AS ball_2,
         max(CASE WHEN rn % 5 = 3 THEN q END) AS ball_3, max(CASE WHEN rn % 5 = 4 THEN q END) AS ball_4,
         max(CASE WHEN rn % 5 = 0 THEN q END) AS ball_5,
         max(CASE WHEN rn % 5 = 1 THEN m END) AS lucky_star_1, max(CASE WHEN rn % 5 = 2 THEN m END) AS lucky_star_2
  FROM r_ JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3),
sd AS (SELECT *, row_number() OVER (ORDER BY draw_date, draw_number, part) AS seq FROM dd),
lng AS (
  SELECT seq, draw_date, draw_number, 'main' AS pool, 1 AS position, ball_1 AS number FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'main', 2, ball_2 FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'main', 3, ball_3 FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'main', 4, ball_4 FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'main', 5, ball_5 FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'star', 1, lucky_star_1 FROM sd
  UNION ALL SELECT seq, draw_date, draw_number, 'star', 2, lucky_star_2 FROM sd),
lg AS (SELECT * FROM lng WHERE number IS NOT NULL),
dom AS (
  SELECT 'main' AS pool, CAST(range AS INTEGER) AS number FROM range(1, 51)
  UNION ALL SELECT 'star', CAST(range AS INTEGER) FROM range(1, 13))
"""


def with_draws(sql_body: str, *ctes: str) -> str:
    """Prefix a query with the derived-draws CTEs (``dd``, ``sd``, ``lg``, ``dom``)
    plus any extra ``name AS (...)`` CTEs."""
    extra = "".join(",\n" + c.strip() for c in ctes)
    return "WITH " + DERIVED_DRAWS_CTE.strip() + extra + "\n" + sql_body.strip()
