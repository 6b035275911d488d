"""Ingest, alignment, calendar, export, page and column-level queries.

O10-O12, O17-O27, O37, O54, O55, O60, O61, O63, O70, F1-F9, F13, V6, V7.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.functions.dates import D_MON_Y, DMY_ABBR, ISO_DATE, day_name, is_weekday, mon_date_text, parse_date
from drawlake.functions.text import (
    blank_to_null, clean_text, last_position, money_to_decimal, sigmoid, split_codes,
)
from drawlake.operators.connector import mask_columns, mask_derived, sparse_nonnull, with_sensitivity, with_xml, xml_values
from drawlake.operators.merge import delete_keys
from drawlake.operators.picks import random_tickets, score_picks
from drawlake.operators.standardize import (
    align_columns, drop_null_rows, filter_not_in, split_valid, standardize, tolerant_int, union_aligned,
)
from drawlake.plans.catalog import register
from drawlake.plans.derived import load_draws, table, with_draws
from drawlake.session import ensure_checkpoint_dir
from drawlake.sources.files import read_csv_table, read_json_table
from drawlake.sources.html import (
    MAIN_SPAN_CLASS, STAR_SPAN_CLASS, TABLE_CONTAINER_CLASS, html_table_rows, nav_links, page_manifest,
)
from drawlake.sources.sinks import JSON_TIMESTAMP_FORMAT, export_table

SPLIT_DATE = "1995-01-01"


@register("union_aligned", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL AS order_code
FROM orders WHERE NOT coalesce(o_orderdate >= TIMESTAMP '{SPLIT_DATE}', false)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'E' || CAST(o_orderkey AS VARCHAR)
FROM orders WHERE coalesce(o_orderdate >= TIMESTAMP '{SPLIT_DATE}', false)
""")
def union_aligned_q(spark, sf_dir):
    """Two layouts of one table (the second has an extra column) unioned by name."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate")
    late = F.coalesce(F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"), F.lit(False))
    first = o.where(~late)
    second = o.where(late).withColumn("order_code", F.concat(F.lit("E"), F.col("o_orderkey").cast("string")))
    return union_aligned([first, second])


@register("align_rename", """
SELECT o_orderkey AS order_key, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS order_date,
       2 AS load_number
FROM orders
""")
def align_rename(spark, sf_dir):
    """Rename map, lower-case, drop and a literal provenance column."""
    o = table(spark, sf_dir, "orders")
    return align_columns(o, {"o_orderkey": "Order_Key", "o_orderdate": "Order_Date"},
                         drop=["o_orderpriority"], lower=True, constants={"load_number": 2})


def _raw_orders(orders):
    """Orders as source text: a dd-MMM-yyyy date, a money text and a customer text,
    broken in known ways by priority (bad date, 'n/a', '12.5'-style, '7.0'-style)."""
    pr = F.col("o_orderpriority")
    date_txt = F.when(pr == "1-URGENT", F.lit("not a date")).otherwise(F.date_format("o_orderdate", DMY_ABBR))
    cust_txt = (F.when(pr == "4-NOT SPECIFIED", F.lit("n/a"))
                 .when(pr == "2-HIGH", F.concat(F.col("o_custkey").cast("string"), F.lit(".5")))
                 .when(pr == "3-MEDIUM", F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
                 .otherwise(F.col("o_custkey").cast("string")))
    money = F.concat(F.lit("£"), F.format_number(F.floor("o_totalprice"), 0))
    return orders.select(F.col("o_orderkey").alias("row_id"), date_txt.alias("date_text"),
                         cust_txt.alias("cust_text"), money.alias("total_text"))


_RAW_SQL = """
WITH raw AS (
  SELECT o_orderkey AS row_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'not a date' ELSE strftime(o_orderdate, '%d-%b-%Y') END AS date_text,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
              WHEN o_orderpriority = '2-HIGH' THEN CAST(o_custkey AS VARCHAR) || '.5'
              WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_custkey AS VARCHAR) || '.0'
              ELSE CAST(o_custkey AS VARCHAR) END AS cust_text,
         '£' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS total_text
  FROM orders),
typed AS (
  SELECT row_id, CAST(try_strptime(date_text, '%d-%b-%Y') AS DATE) AS draw_date,
         CASE WHEN TRY_CAST(cust_text AS DOUBLE) = floor(TRY_CAST(cust_text AS DOUBLE))
              THEN CAST(TRY_CAST(cust_text AS DOUBLE) AS INTEGER) END AS custkey,
         TRY_CAST(regexp_replace(total_text, '[^0-9.]', '', 'g') AS DECIMAL(18,2)) AS total
  FROM raw)
"""


def _typed(spark, sf_dir):
    raw = _raw_orders(table(spark, sf_dir, "orders"))
    return raw.select("row_id", parse_date("date_text", DMY_ABBR).alias("draw_date"),
                      tolerant_int("cust_text").alias("custkey"),
                      money_to_decimal("total_text").alias("total"))


@register("tolerant_cast", _RAW_SQL + "SELECT * FROM typed")
def tolerant_cast(spark, sf_dir):
    """Text columns parsed without ever failing: bad values become null (O22, F1, money)."""
    return _typed(spark, sf_dir)


@register("quarantine", _RAW_SQL + """
SELECT row_id, concat_ws(',', CASE WHEN draw_date IS NULL THEN 'draw_date' END,
                              CASE WHEN custkey IS NULL THEN 'custkey' END) AS _reason
FROM typed WHERE draw_date IS NULL OR custkey IS NULL
""")
def quarantine(spark, sf_dir):
    """Rows failing a rule, with the failed rule names."""
    _, bad = split_valid(_typed(spark, sf_dir), {"draw_date": F.col("draw_date").isNotNull(),
                                                 "custkey": F.col("custkey").isNotNull()})
    return bad.select("row_id", "_reason")


@register("day_name", """
SELECT dayname(o_orderdate) AS day_name, upper(strftime(o_orderdate, '%Y-%b-%d')) AS date_text, *
FROM orders
""")
def day_name_q(spark, sf_dir):
    """Weekday name and YYYY-MON-DD text ahead of all columns."""
    o = table(spark, sf_dir, "orders")
    return o.select(day_name("o_orderdate").alias("day_name"),
                    mon_date_text("o_orderdate").alias("date_text"), "*")


@register("weekday_filter", """
SELECT * FROM orders WHERE dayname(o_orderdate) = 'Tuesday'
""")
def weekday_filter(spark, sf_dir):
    """Rows on one weekday."""
    return table(spark, sf_dir, "orders").where(is_weekday("o_orderdate", "Tuesday"))


@register("not_in_days", """
SELECT o_orderkey, o_orderdate, dayname(o_orderdate) AS day_name FROM orders
WHERE dayname(o_orderdate) NOT IN ('Tuesday', 'Friday')
""")
def not_in_days(spark, sf_dir):
    """Rows whose derived weekday is not an expected draw day."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate",
                                              day_name("o_orderdate").alias("day_name"))
    return filter_not_in(o, "day_name", ["Tuesday", "Friday"])


@register("draw_count", with_draws("SELECT count(*) AS n FROM dd"))
def draw_count(spark, sf_dir):
    """Total row count."""
    return load_draws(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@register("latest_draws", with_draws("""
SELECT dayname(draw_date) AS day_name, upper(strftime(draw_date, '%Y-%b-%d')) AS date_text, *
FROM dd ORDER BY draw_date DESC, draw_number DESC, part DESC LIMIT 2000
"""))
def latest_draws(spark, sf_dir):
    """Investigation view: newest 2000 draws with day name and date text."""
    d = load_draws(spark, sf_dir)
    return (d.select(day_name("draw_date").alias("day_name"),
                     mon_date_text("draw_date").alias("date_text"), "*")
             .orderBy(F.col("draw_date").desc(), F.col("draw_number").desc(), F.col("part").desc()).limit(2000))


_EXPORT_SCHEMA = T.StructType([
    T.StructField("O_ORDERKEY", T.LongType()), T.StructField("O_CUSTKEY", T.LongType()),
    T.StructField("O_ORDERSTATUS", T.StringType()), T.StructField("O_TOTALPRICE", T.DoubleType()),
    T.StructField("O_ORDERDATE", T.StringType()), T.StructField("O_ORDERPRIORITY", T.StringType()),
])


@register("export_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders
""")
def export_roundtrip(spark, sf_dir):
    """JSON-lines export with upper-case keys and ISO timestamps, read back."""
    o = table(spark, sf_dir, "orders")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    export_table(o.toDF(*[c.upper() for c in o.columns]), out, "json")
    back = read_json_table(spark, out, _EXPORT_SCHEMA, lower=True)
    return back.withColumn("o_orderdate", F.to_date(F.try_to_timestamp(
        F.col("o_orderdate"), F.lit(JSON_TIMESTAMP_FORMAT))))


@register("export_csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def export_csv_roundtrip(spark, sf_dir):
    """CSV export with header and ``yyyy-MM-dd HH:mm:ss`` timestamps, read back."""
    o = table(spark, sf_dir, "orders")
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    export_table(o, out, "csv")
    schema = T.StructType([T.StructField(f.name, f.dataType if f.name != "o_orderdate" else T.StringType())
                           for f in o.schema.fields])
    back = read_csv_table(spark, out, schema)
    return back.withColumn("o_orderdate", F.try_to_timestamp("o_orderdate", F.lit("yyyy-MM-dd HH:mm:ss"))
                           .cast("timestamp_ntz"))


@register("page_nav_links", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS link_idx, links[i] AS href
FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS links FROM pages) p,
     LATERAL generate_series(1, len(links)) AS g(i)
""")
def page_nav_links(spark, sf_dir):
    """Every list-item link of every page, in page order (O6, link lists)."""
    return nav_links(table(spark, sf_dir, "pages"))


MANIFEST_YEARS = list(range(2004, 2026))


@register("page_manifest", """
WITH sites AS (
  SELECT DISTINCT regexp_extract(url, '^(\\w+)://([^/?#]+)', 1) AS scheme,
                  regexp_extract(url, '^(\\w+)://([^/?#]+)', 2) AS host
  FROM pages),
wanted AS (
  SELECT host, CAST(y AS INTEGER) AS year, scheme || '://' || host || '/draw-history/year/' || CAST(y AS VARCHAR) || '/' AS url
  FROM sites, range(2004, 2026) r(y) WHERE host <> '')
SELECT host, year, url FROM wanted WHERE url NOT IN (SELECT url FROM pages)
""")
def page_manifest_q(spark, sf_dir):
    """Yearly archive pages still to fetch for every site seen."""
    return page_manifest(table(spark, sf_dir, "pages"), MANIFEST_YEARS)


@register("page_table_rows", """
SELECT page_id, CAST(NULL AS INTEGER) AS row_idx, NULL AS draw_date, NULL AS ball_1, NULL AS ball_2, NULL AS ball_3,
       NULL AS ball_4, NULL AS ball_5, NULL AS lucky_star_1, NULL AS lucky_star_2, NULL AS jackpot, NULL AS winners,
       'no results table' AS _reason
FROM pages
""")
def page_table_rows(spark, sf_dir):
    """Results-table rows scraped from every page, skip reasons included (O6); the given pages hold none."""
    return html_table_rows(table(spark, sf_dir, "pages"))


def order_pages(spark, sf_dir):
    """One results page per order: a table row for each draw derived from its lines."""
    span = lambda c, cls: F.when(F.col(c).isNotNull(), F.concat(
        F.lit(f'<span class="{cls}">'), F.col(c).cast("string"), F.lit("</span>"))).otherwise(F.lit(""))
    balls = F.concat(*[span(f"ball_{i}", MAIN_SPAN_CLASS) for i in range(1, 6)],
                     *[span(f"lucky_star_{i}", STAR_SPAN_CLASS) for i in (1, 2)])
    row = F.concat(F.lit("<tr><td>"), F.date_format("draw_date", "d MMM yyyy"), F.lit("<td>"), balls,
                   F.lit("</td><td>&pound;"), F.col("draw_number").cast("string"), F.lit("</td><td>0</td></tr>"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", row.alias("row")))), lambda r: r["row"]), "")
    html = F.concat(F.lit(f'<html><p>Draws<p>of one order<div class="{TABLE_CONTAINER_CLASS}"><table><thead><tr><th>Draw Date</th>'
                          "<th>Numbers</th><th>Jackpot</th><th>Winners</th></tr></thead><tbody>"), body,
                    F.lit("</tbody></table></div></html>"))
    return load_draws(spark, sf_dir).groupBy(F.col("draw_number").alias("page_id")).agg(html.alias("html"))


@register("html_table_roundtrip", with_draws("""
SELECT draw_number AS page_id, part AS row_idx, strftime(draw_date, '%-d %b %Y') AS draw_date,
       CAST(ball_1 AS VARCHAR) AS ball_1, CAST(ball_2 AS VARCHAR) AS ball_2, CAST(ball_3 AS VARCHAR) AS ball_3,
       CAST(ball_4 AS VARCHAR) AS ball_4, CAST(ball_5 AS VARCHAR) AS ball_5,
       CAST(lucky_star_1 AS VARCHAR) AS lucky_star_1, CAST(lucky_star_2 AS VARCHAR) AS lucky_star_2,
       '£' || CAST(draw_number AS VARCHAR) AS jackpot, '0' AS winners,
       CASE WHEN ball_5 IS NULL THEN 'expected 5 + 2 numbers, found '
            || CAST((ball_1 IS NOT NULL)::INT + (ball_2 IS NOT NULL)::INT + (ball_3 IS NOT NULL)::INT + (ball_4 IS NOT NULL)::INT AS VARCHAR)
            || ' + ' || CAST((lucky_star_1 IS NOT NULL)::INT + (lucky_star_2 IS NOT NULL)::INT AS VARCHAR) END AS _reason
FROM dd
"""))
def html_table_roundtrip(spark, sf_dir):
    """Result pages built from every order (with unclosed cells and paragraphs), parsed back."""
    return html_table_rows(order_pages(spark, sf_dir))


@register("random_tickets", with_draws("""
SELECT ticket_id, pool, CAST(row_number() OVER (PARTITION BY ticket_id, pool ORDER BY number) - 1 AS INTEGER) AS pos, number
FROM (SELECT d.draw_number * 100 + d.part AS ticket_id, dom.pool, dom.number,
             row_number() OVER (PARTITION BY d.draw_number, d.part, dom.pool ORDER BY
               md5('42:' || dom.pool || ':' || CAST(d.draw_number * 100 + d.part AS VARCHAR) || ':' || CAST(dom.number AS VARCHAR)),
               dom.number) AS r
      FROM dd d CROSS JOIN dom)
WHERE r <= CASE pool WHEN 'main' THEN 5 ELSE 2 END
"""))
def random_tickets_q(spark, sf_dir):
    """One seeded random ticket per draw, in long form."""
    d = load_draws(spark, sf_dir).select((F.col("draw_number") * 100 + F.col("part")).alias("ticket_id"))
    t = random_tickets(d)
    cells = [F.transform(f"{p}_numbers", _ticket_cell(p)) for p in ("main", "star")]
    return t.select("ticket_id", F.inline(F.concat(*cells)))


def _ticket_cell(pool: str):
    return lambda n, i: F.struct(F.lit(pool).alias("pool"), i.alias("pos"), n.alias("number"))


@register("sparse_nonnull", """
SELECT c_custkey, 'c_name' AS column_name, c_name AS value FROM customer WHERE c_name IS NOT NULL
UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey IS NOT NULL
UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL
""")
def sparse_nonnull_q(spark, sf_dir):
    """Non-null cells as name/value rows (V6)."""
    return sparse_nonnull(table(spark, sf_dir, "customer"), ["c_custkey"],
                          ["c_name", "c_nationkey", "c_mktsegment"])


@register("masked_customer", """
SELECT c_custkey,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
       c_nationkey, c_mktsegment
FROM customer
""")
def masked_customer(spark, sf_dir):
    """Labelled columns masked on read (V7)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    c = with_sensitivity(c, {"c_name": {"label": "Confidential", "information_type": "Name"}})
    return mask_columns(c)


_MASK_SQL = "regexp_replace(regexp_replace(regexp_replace({}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"


@register("masked_descendants", f"""
SELECT n_name, c_mktsegment, count(*) AS customers, {_MASK_SQL.format("max(c_name)")} AS last_name,
       {_MASK_SQL.format("max(n_name || ' / ' || c_name)")} AS place, CAST(NULL AS INTEGER) AS longest,
       max(length(c_mktsegment)) AS segment_length
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment
""")
def masked_descendants(spark, sf_dir):
    """Renamed, joined, concatenated and aggregated columns: those that descend from a labelled one are masked (V7)."""
    c = with_sensitivity(table(spark, sf_dir, "customer"), {"c_name": {"label": "Confidential", "information_type": "Name"}})
    c = c.withColumnRenamed("c_name", "who").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("at", F.concat_ws(" / ", "n_name", "who")).withColumn("size", F.length("who"))
    return mask_derived(c.groupBy("n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.max("who").alias("last_name"), F.max("at").alias("place"),
        F.max("size").alias("longest"), F.max(F.length("c_mktsegment")).alias("segment_length")))


@register("xml_roundtrip", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def xml_roundtrip(spark, sf_dir):
    """Columns written to an XML column, and read back from it by XPath (V5)."""
    c = with_xml(table(spark, sf_dir, "customer"), "x", ["c_name", "c_mktsegment"])
    return xml_values(c.select("c_custkey", "x"), "x", {"c_name": "row/c_name", "c_mktsegment": "row/c_mktsegment"}).drop("x")


@register("scalar_functions", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso_date, CAST(o_orderdate AS DATE) AS mon_date,
       lower(o_orderpriority) AS priority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
       1.0 / (1.0 + exp(-(o_totalprice / 100000.0))) AS logistic,
       CASE WHEN o_orderstatus = 'O' THEN 3 WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS last_at,
       CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS n_codes
FROM orders
""")
def scalar_functions(spark, sf_dir):
    """Dates in two text forms, trim and lower, blank to null, sigmoid, last position, code lists."""
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    codes = F.when(status == "P", F.lit(" P, ")).otherwise(F.concat(F.lit("A , "), status))
    return o.select(
        "o_orderkey", parse_date(F.date_format("o_orderdate", ISO_DATE), ISO_DATE).alias("iso_date"),
        parse_date(F.date_format("o_orderdate", D_MON_Y), D_MON_Y).alias("mon_date"),
        clean_text(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("priority"),
        blank_to_null(F.when(status == "P", F.lit("  ")).otherwise(status)).alias("status"),
        sigmoid(F.col("o_totalprice") / 100000.0).alias("logistic"),
        last_position(F.array(F.lit("F"), F.lit("O"), F.lit("O")), status).cast("int").alias("last_at"),
        F.size(split_codes(codes)).alias("n_codes"))


@register("standardize_draws", with_draws("""
SELECT draw_date, draw_number, ball_1, ball_2, ball_3, ball_4, ball_5, lucky_star_1, lucky_star_2 FROM dd
"""))
def standardize_draws(spark, sf_dir):
    """Upper-case names, timestamp text and numbers as text, brought to the core columns."""
    d = load_draws(spark, sf_dir)
    raw = d.select(F.date_format("draw_date", "yyyy-MM-dd HH:mm:ss").alias("DRAW_DATE"), F.lit("x").alias("OTHER"),
                   *[F.concat(F.col(c).cast("string"), F.lit(".0")).alias(c.upper()) for c in d.columns
                     if c not in ("draw_date", "part")])
    return standardize(raw).withColumn("draw_number", F.col("draw_number").cast("long"))


@register("complete_draws", with_draws("SELECT * FROM dd WHERE ball_5 IS NOT NULL"))
def complete_draws(spark, sf_dir):
    """Draws without a missing main number."""
    return drop_null_rows(load_draws(spark, sf_dir), ["ball_5"])


@register("delete_keys", """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
""")
def delete_keys_q(spark, sf_dir):
    """Rows whose key is in another table removed."""
    gone = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return delete_keys(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), gone, ["o_orderkey"])


@register("score_picks", with_draws("""
SELECT ticket_id,
       CAST(count(DISTINCT CASE WHEN t.pool = 'main' AND l.number IS NOT NULL THEN t.number END) AS INTEGER) AS main_matches,
       CAST(count(DISTINCT CASE WHEN t.pool = 'star' AND l.number IS NOT NULL THEN t.number END) AS INTEGER) AS star_matches
FROM (SELECT d.draw_number * 100 + d.part AS ticket_id, d.draw_number, d.part, dom.pool, dom.number,
             row_number() OVER (PARTITION BY d.draw_number, d.part, dom.pool ORDER BY
               md5('42:' || dom.pool || ':' || CAST(d.draw_number * 100 + d.part AS VARCHAR) || ':' || CAST(dom.number AS VARCHAR)),
               dom.number) AS r
      FROM dd d CROSS JOIN dom) t
LEFT JOIN (SELECT DISTINCT sd.draw_number, sd.part, lg.pool, lg.number FROM lg JOIN sd ON sd.seq = lg.seq) l
  ON l.draw_number = t.draw_number AND l.part = t.part AND l.pool = t.pool AND l.number = t.number
WHERE r <= CASE t.pool WHEN 'main' THEN 5 ELSE 2 END
GROUP BY ticket_id
"""))
def score_picks_q(spark, sf_dir):
    """Every random ticket scored against its draw."""
    d = load_draws(spark, sf_dir).withColumn("ticket_id", F.col("draw_number") * 100 + F.col("part"))
    scored = score_picks(random_tickets(d.select("ticket_id")), d, "ticket_id")
    return scored.select("ticket_id", "main_matches", "star_matches")
