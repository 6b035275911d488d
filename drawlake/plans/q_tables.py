"""Queries of file layouts, managed tables and whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.functions.dates import DMY_ABBR, ISO_DATE
from drawlake.functions.text import money_to_decimal
from drawlake.operators.features import history_guard, sliding_features, start_index
from drawlake.operators.merge import delete_where, update_where
from drawlake.plans.catalog import register
from drawlake.plans.derived import load_draws, sequenced_draws, table, with_draws
from drawlake.plans.job import JobConfig, run_draw_job
from drawlake.schemas import NUMBER_COLUMNS, SCRAPED_COLUMNS, SOURCE1_RENAMES, SOURCE1_V1_SCHEMA, SOURCE1_V2_SCHEMA, SOURCE2_RENAMES
from drawlake.session import scratch_path, write_and_reread
from drawlake.sources.files import read_scraped, read_source1, read_source2
from drawlake.sources.sinks import ensure_table, export_table, insert_rows, table_report, truncate_table

LAYOUT_DATE = "1995-01-01"
_NUMBERS = ", ".join(NUMBER_COLUMNS)


@register("source1_layouts", with_draws(f"""
SELECT draw_date, {_NUMBERS}, 'U' || CAST(draw_number AS VARCHAR) || ',V' || CAST(part AS VARCHAR) AS uk_millionaire_maker,
       CASE WHEN part = 1 THEN NULL ELSE draw_number END AS draw_number
FROM dd
"""))
def source1_layouts(spark, sf_dir):
    """All draws as CSV files of two layouts, read back by one scan.

    Codes are cells with commas, short draws have empty cells, and second draws of an order no number.
    """
    d = load_draws(spark, sf_dir)
    d = d.select("draw_date", F.date_format("draw_date", DMY_ABBR).alias("DrawDate"),
                 *[F.col(new).alias(old) for old, new in SOURCE1_RENAMES.items() if new in NUMBER_COLUMNS],
                 F.concat(F.lit("U"), "draw_number", F.lit(",V"), "part").alias("UK Millionaire Maker"),
                 F.when(F.col("part") == 0, F.lit("7")).alias("European Millionaire Maker"),
                 F.when(F.col("part") != 1, F.col("draw_number")).alias("DrawNumber"))
    old = F.coalesce(F.col("draw_date") < LAYOUT_DATE, F.lit(False))
    paths = [scratch_path(spark, "layout1"), scratch_path(spark, "layout2")]
    export_table(d.where(old).select(*SOURCE1_V1_SCHEMA.names), paths[0], skip_empty=False)
    export_table(d.where(~old).select(*SOURCE1_V2_SCHEMA.names), paths[1], skip_empty=False)
    return read_source1(spark, paths)


@register("source2_semicolon", with_draws(f"SELECT draw_date, {_NUMBERS}, 2 AS load_number FROM dd"))
def source2_semicolon(spark, sf_dir):
    """All draws as a ``;`` file with winner and gain, read back without them."""
    d = load_draws(spark, sf_dir)
    path = scratch_path(spark, "semicolon")
    export_table(d.select(F.date_format("draw_date", ISO_DATE).alias("Date"),
                          *[F.col(new).alias(old) for old, new in SOURCE2_RENAMES.items() if new in NUMBER_COLUMNS],
                          F.lit("a;b").alias("Winner"), F.col("part").cast("string").alias("Gain")), path, sep=";", skip_empty=False)
    return read_source2(spark, path)


@register("scraped_text", with_draws(f"""
SELECT draw_date, {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in NUMBER_COLUMNS)},
       '£' || format('{{:,}}', CAST(draw_number AS BIGINT)) AS jackpot,
       CASE WHEN part > 0 THEN CAST(part AS VARCHAR) END AS winners, CAST(draw_number AS DECIMAL(18,2)) AS amount
FROM dd
"""))
def scraped_text(spark, sf_dir):
    """All draws as scraped cells: read as text, empty cells null, the date and the money parsed (O3)."""
    d = load_draws(spark, sf_dir)
    path = scratch_path(spark, "scraped")
    cells = d.withColumns({"draw_date": F.date_format("draw_date", ISO_DATE),
                           "jackpot": F.concat(F.lit("£"), F.format_number("draw_number", 0)),
                           "winners": F.when(F.col("part") > 0, F.col("part").cast("string"))})
    export_table(cells.select(*SCRAPED_COLUMNS), path, skip_empty=False)
    return read_scraped(spark, path).withColumn("amount", money_to_decimal("jackpot"))


_ORDER_TABLE = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType(), False),
    T.StructField("o_orderstatus", T.StringType(), True, {"comment": "F, O or P"}), T.StructField("o_totalprice", T.DoubleType()),
])


def _order_table(spark, unique=()):
    name = f"orders_{uuid.uuid4().hex}"
    ensure_table(spark, name, _ORDER_TABLE, comment="orders", primary_key=["o_orderkey"], unique=unique)
    return name


def _filled(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*_ORDER_TABLE.names)


@register("table_rows", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, NULL FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT -1, 7, 'F', 12.5
""")
def table_rows(spark, sf_dir):
    """A table created with its constraints, filled, truncated, filled again in two parts (the second without a price)
    and given a literal row by a select without a table (O14-O16, O25); copied, then dropped."""
    name, orders = _order_table(spark), _filled(spark, sf_dir)
    try:
        insert_rows(spark, name, orders)
        truncate_table(spark, name)
        insert_rows(spark, name, orders.where("o_orderstatus = 'F'"))
        insert_rows(spark, name, orders.where("o_orderstatus <> 'F'").drop("o_totalprice"))
        insert_rows(spark, name, spark.sql("SELECT -1L AS o_orderkey, 7L AS o_custkey, 'F' AS o_orderstatus, 12.5D AS o_totalprice"))
        return write_and_reread(spark.table(name), "rows")
    finally:
        spark.sql(f"DROP TABLE {name}")


@register("table_report", """
SELECT 'not_null' AS rule, 'o_orderkey' AS columns, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'unique', 'o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'o_custkey,o_orderstatus', count(*) FROM
  (SELECT 1 FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)
""")
def table_report_q(spark, sf_dir):
    """The constraints a table declares, counted over rows that were written past them."""
    name = _order_table(spark, unique=[["o_custkey", "o_orderstatus"]])
    try:
        _filled(spark, sf_dir).write.insertInto(name)
        return write_and_reread(table_report(spark, name).drop("table_name"), "report")
    finally:
        spark.sql(f"DROP TABLE {name}")


@register("update_delete_rows", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, 3 AS load_number
FROM orders WHERE NOT coalesce(o_orderpriority = '5-LOW' AND o_totalprice < 50000, false)
""")
def update_delete_rows(spark, sf_dir):
    """A conditional update of two columns, an unconditional one, and a conditional delete."""
    o = table(spark, sf_dir, "orders")
    left = delete_where(o, "o_orderpriority = '5-LOW' AND o_totalprice < 50000")
    pending = F.col("o_orderstatus") == "P"
    left = update_where(left, pending, {"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": "pending"})
    return update_where(left.withColumn("load_number", F.lit(2)), "true", {"load_number": 3}).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "load_number")


@register("guarded_targets", with_draws("""
SELECT mode, CAST(21 AS BIGINT) AS first_target, max(seq) + added AS last_target, count(*) - 20 + added AS targets
FROM sd CROSS JOIN (SELECT 'holdout' AS mode, 0 AS added UNION ALL SELECT 'next', 1) GROUP BY mode, added
"""))
def guarded_targets(spark, sf_dir):
    """The target rows that the history allows, asked for after the guard, in both modes."""
    sd = sequenced_draws(spark, sf_dir)
    parts = []
    for mode in ("holdout", "next"):
        history_guard(sd, mode=mode)
        parts.append(sliding_features(sd, mode=mode).agg(
            F.lit(mode).alias("mode"), F.min("seq").alias("first_target"), F.max("seq").alias("last_target"),
            F.count(F.when(F.col("seq") >= start_index(), F.col("features"))).alias("targets")))
    return parts[0].unionByName(parts[1])


@register("tuesday_job_picks", with_draws("""
SELECT pool, pick_rank, number, frequency FROM (
  SELECT pool, number, count(*) AS frequency,
         CAST(row_number() OVER (PARTITION BY pool ORDER BY count(*) DESC, number) AS INTEGER) AS pick_rank
  FROM lg WHERE dayname(draw_date) = 'Tuesday' GROUP BY pool, number)
WHERE pick_rank <= CASE pool WHEN 'main' THEN 5 ELSE 2 END
"""))
def tuesday_job_picks(spark, sf_dir):
    """The whole job, from raw draws to published picks, for one weekday and strategy."""
    cfg = JobConfig(output_dir=scratch_path(spark, "job") + "/out", target=load_draws(spark, sf_dir), weekday="tuesday",
                    strategy="most_frequent")
    return spark.read.parquet(run_draw_job(spark, cfg)["outputs"]["picks"])
