"""Reconcile, upsert, constraint and duplicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawlake.operators.digest import reconcile_by_digest, summary_by_digest
from drawlake.operators.merge import upsert
from drawlake.operators.reconcile import (
    check_constraints, find_duplicates, gate_status, only_in, reconcile, reconcile_summary,
)
from drawlake.plans.catalog import register
from drawlake.plans.derived import table
from drawlake.session import scratch_path
from drawlake.sources.snapshots import create_table, merge_into, read_latest
from drawlake.sources.unique_keys import append_unique, repeated_keys, unique_report

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
COMPARE = ORDER_COLS[1:]
NEW_KEY_OFFSET = 10_000_000


def second_copy(orders):
    """A second copy of orders that differs from the first in known ways.

    Status 'P' orders are missing, '2-HIGH' prices are shifted by one,
    '3-MEDIUM' open orders lost their customer (null, not a mismatch by
    default), '5-LOW' orders re-appear under new keys, and 'F' orders of
    the first day of a month with priority '4-NOT SPECIFIED' appear twice.
    """
    base = orders.select(*ORDER_COLS)
    kept = (base.where(F.col("o_orderstatus") != "P")
                .withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "2-HIGH",
                                                   F.col("o_totalprice") + 1.0)
                                             .otherwise(F.col("o_totalprice")))
                .withColumn("o_custkey", F.when((F.col("o_orderpriority") == "3-MEDIUM")
                                                & (F.col("o_orderstatus") == "O"), F.lit(None))
                                          .otherwise(F.col("o_custkey"))))
    added = (base.where(F.col("o_orderpriority") == "5-LOW")
                 .withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEY_OFFSET))
    doubled = base.where((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F")
                         & (F.dayofmonth("o_orderdate") == 1))
    return kept.unionByName(added).unionByName(doubled)


_SECOND_COPY_SQL = """
lft AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
rgt AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS o_custkey,
         o_orderstatus,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' AND day(o_orderdate) = 1)
"""

_AGG_COLS = ", ".join(f"max({c}) AS {c}" for c in COMPARE)
_MATCH = ",\n  ".join(
    f"a.{c} AS {c}_left, b.{c} AS {c}_right, "
    f"CASE WHEN status = 'both' THEN coalesce(a.{c} = b.{c}, true) END AS {c}_match" for c in COMPARE)
_ALL_MATCH = " AND ".join(f"coalesce(a.{c} = b.{c}, true)" for c in COMPARE)

_RECON_SQL = _SECOND_COPY_SQL + f""",
la AS (SELECT o_orderkey, count(*) AS n, {_AGG_COLS} FROM lft GROUP BY o_orderkey),
ra AS (SELECT o_orderkey, count(*) AS n, {_AGG_COLS} FROM rgt GROUP BY o_orderkey),
rec AS (
  SELECT o_orderkey, left_rows, right_rows, status,
  {_MATCH},
  status = 'both' AND NOT ({_ALL_MATCH}) AS mismatch
  FROM (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
               CASE WHEN a.n IS NULL THEN 'right_only' WHEN b.n IS NULL THEN 'left_only'
                    WHEN a.n = 1 AND b.n = 1 THEN 'both' ELSE 'duplicate' END AS status,
               {", ".join(f"a.{c} AS a_{c}, b.{c} AS b_{c}" for c in COMPARE)}
        FROM la a FULL OUTER JOIN ra b ON a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey) x,
       LATERAL (SELECT {", ".join(f"x.a_{c} AS {c}" for c in COMPARE)}) a,
       LATERAL (SELECT {", ".join(f"x.b_{c} AS {c}" for c in COMPARE)}) b)
"""


def _recon(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return reconcile(orders.select(*ORDER_COLS), second_copy(orders), ["o_orderkey"], COMPARE)


@register("reconcile_summary", "WITH " + _RECON_SQL.strip() + """
SELECT count(*) FILTER (WHERE status = 'left_only') AS left_only,
       count(*) FILTER (WHERE status = 'right_only') AS right_only,
       count(*) FILTER (WHERE status = 'both') AS both,
       count(*) FILTER (WHERE status = 'duplicate') AS duplicate,
       count(*) FILTER (WHERE mismatch) AS mismatched,
       count(*) FILTER (WHERE status = 'both' AND NOT mismatch) AS matched
FROM rec
""")
def reconcile_summary_q(spark, sf_dir):
    return reconcile_summary(_recon(spark, sf_dir))


@register("reconcile_mismatch", "WITH " + _RECON_SQL.strip() + """
SELECT * FROM rec WHERE mismatch
""")
def reconcile_mismatch(spark, sf_dir):
    return _recon(spark, sf_dir).where(F.col("mismatch"))


@register("reconcile_status", "WITH " + _RECON_SQL.strip() + """
SELECT o_orderkey, left_rows, right_rows, status FROM rec
""")
def reconcile_status(spark, sf_dir):
    return _recon(spark, sf_dir).select("o_orderkey", "left_rows", "right_rows", "status")


@register("reconcile_digest", "WITH " + _RECON_SQL.strip() + """
SELECT o_orderkey, left_rows, right_rows, status, coalesce(mismatch, false) AS mismatch,
       CASE WHEN status <> 'duplicate' THEN o_totalprice_left END AS o_totalprice_left FROM rec
""")
def reconcile_digest(spark, sf_dir):
    """Every key of the reconcile, by a tree of digests that leaves equal parts where they are."""
    orders = table(spark, sf_dir, "orders")
    return reconcile_by_digest(orders.select(*ORDER_COLS), second_copy(orders), ["o_orderkey"], COMPARE).select(
        "o_orderkey", "left_rows", "right_rows", "status", "mismatch", "o_totalprice_left")


@register("reconcile_near_copy", """
WITH lft AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
rgt AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate = (SELECT max(o_orderdate) FROM orders) THEN o_totalprice + 1
               ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderdate > (SELECT min(o_orderdate) FROM orders))
SELECT count(*) FILTER (WHERE r.o_orderkey IS NULL) AS left_only, count(*) FILTER (WHERE l.o_orderkey IS NULL) AS right_only,
       count(*) FILTER (WHERE l.o_orderkey IS NOT NULL AND r.o_orderkey IS NOT NULL) AS both, 0::BIGINT AS duplicate,
       count(*) FILTER (WHERE l.o_totalprice <> r.o_totalprice) AS mismatched,
       count(*) FILTER (WHERE l.o_totalprice = r.o_totalprice) AS matched
FROM lft l FULL JOIN rgt r USING (o_orderkey)
""")
def reconcile_near_copy(spark, sf_dir):
    """Counts of two copies that differ on the first and the last day only: equal parts are never shuffled."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    day = F.col("o_orderdate")
    copy = orders.where(day > F.lit(first)).withColumn(
        "o_totalprice", F.when(day == F.lit(last), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return summary_by_digest(orders, copy, ["o_orderkey"], ["o_custkey", "o_totalprice"])


@register("only_left", "WITH " + _SECOND_COPY_SQL.strip() + """
SELECT * FROM lft WHERE NOT EXISTS (SELECT 1 FROM rgt WHERE rgt.o_orderkey IS NOT DISTINCT FROM lft.o_orderkey)
""")
def only_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return only_in(orders.select(*ORDER_COLS), second_copy(orders), ["o_orderkey"])


@register("only_right", "WITH " + _SECOND_COPY_SQL.strip() + """
SELECT * FROM rgt WHERE NOT EXISTS (SELECT 1 FROM lft WHERE lft.o_orderkey IS NOT DISTINCT FROM rgt.o_orderkey)
""")
def only_right(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return only_in(second_copy(orders), orders.select(*ORDER_COLS), ["o_orderkey"])


def order_updates(orders):
    """Source rows for the upsert: re-priced '2-HIGH' orders and new '5-LOW' orders."""
    base = orders.select(*ORDER_COLS)
    changed = (base.where(F.col("o_orderpriority") == "2-HIGH")
                   .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    added = (base.where(F.col("o_orderpriority") == "5-LOW")
                 .withColumn("o_orderkey", F.col("o_orderkey") + NEW_KEY_OFFSET))
    return changed.unionByName(added)


_UPSERT_SQL = f"""
WITH src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW')
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  {", ".join(f"CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in COMPARE)}
FROM (SELECT {", ".join(ORDER_COLS)} FROM orders) t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey
"""


@register("upsert_orders", _UPSERT_SQL)
def upsert_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return upsert(orders.select(*ORDER_COLS), order_updates(orders), ["o_orderkey"])


@register("upsert_orders_shuffle", _UPSERT_SQL)
def upsert_orders_shuffle(spark, sf_dir):
    """The same merge with joins that may not broadcast: the answer is the same."""
    orders = table(spark, sf_dir, "orders")
    return upsert(orders.select(*ORDER_COLS), order_updates(orders).hint("merge"), ["o_orderkey"])


@register("merge_order_files", _UPSERT_SQL)
def merge_order_files(spark, sf_dir):
    """The same merge into a table of files: only files that hold a merged key are written again."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLS)
    path = scratch_path(spark, "orders")
    create_table(path, orders, ["o_orderkey"], file_rows=5_000)
    merge_into(path, order_updates(orders), ["o_orderkey"], file_rows=5_000)
    return read_latest(spark, path)


@register("upsert_lines", """
WITH src AS (
  SELECT o_orderkey AS l_orderkey, arg_max(o_totalprice, (coalesce(ord, -1), price)) AS l_extendedprice
  FROM (SELECT o_orderkey, o_totalprice, o_totalprice AS price,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS ord
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_totalprice + 1, o_totalprice + 1, NULL FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey + 10000000, o_totalprice, o_totalprice, NULL FROM orders WHERE o_orderpriority = '5-LOW')
  GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, coalesce(s.l_extendedprice, l.l_extendedprice) AS l_extendedprice
FROM lineitem l LEFT JOIN src s ON s.l_orderkey = l.l_orderkey
UNION ALL
SELECT l_orderkey, NULL, NULL, l_extendedprice FROM src WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def upsert_lines(spark, sf_dir):
    """Merge where target keys repeat (lines of an order), the source lacks columns of the
    target, repeats keys and has null order values (O13)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.col("o_totalprice")
    first = o.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"), price.alias("l_extendedprice"),
        F.when(~urgent, F.col("o_custkey")).alias("ord"))
    again = o.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"), (price + 1).alias("l_extendedprice"), F.lit(None).cast("long").alias("ord"))
    new = o.where("o_orderpriority = '5-LOW'").select(
        (F.col("o_orderkey") + NEW_KEY_OFFSET).alias("l_orderkey"), price.alias("l_extendedprice"),
        F.lit(None).cast("long").alias("ord"))
    return upsert(lines, first.unionByName(again).unionByName(new), ["l_orderkey"], order_col="ord")


@register("quality_gate", "WITH " + _RECON_SQL.strip() + """
SELECT count(*) FILTER (WHERE status = 'left_only') AS left_only,
       count(*) FILTER (WHERE status = 'right_only') AS right_only,
       count(*) FILTER (WHERE status = 'both') AS both,
       count(*) FILTER (WHERE status = 'duplicate') AS duplicate,
       count(*) FILTER (WHERE mismatch) AS mismatched,
       count(*) FILTER (WHERE status = 'both' AND NOT mismatch) AS matched,
       count(*) FILTER (WHERE status = 'left_only') <= 0 AND count(*) FILTER (WHERE mismatch) <= 1000000 AS passed
FROM rec
""")
def quality_gate_q(spark, sf_dir):
    """The gate's verdict on the reconcile summary (O69); it fails here, for orders missing on one side."""
    return gate_status(reconcile_summary(_recon(spark, sf_dir)), {"left_only": 0, "mismatched": 1_000_000})


@register("constraint_report", """
SELECT 'customer' AS table_name, 'not_null' AS rule, 'c_custkey' AS columns,
       count(*) FILTER (WHERE c_custkey IS NULL) AS violations FROM customer
UNION ALL SELECT 'customer', 'not_null', 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM customer
UNION ALL SELECT 'customer', 'not_null', 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL) FROM customer
UNION ALL SELECT 'customer', 'unique', 'c_custkey', count(*) FROM
  (SELECT c_custkey FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'not_null', 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', count(*) FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
""")
def constraint_report(spark, sf_dir):
    c = check_constraints(table(spark, sf_dir, "customer"), "customer",
                          not_null=["c_custkey", "c_name", "c_nationkey"], unique=[["c_custkey"]])
    li = check_constraints(table(spark, sf_dir, "lineitem"), "lineitem",
                           not_null=["l_orderkey", "l_linenumber"], unique=[["l_orderkey", "l_linenumber"]])
    return c.unionByName(li)


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return find_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("latest_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
ORDER BY l_orderkey DESC, l_linenumber DESC LIMIT 2000
""")
def latest_duplicate_keys(spark, sf_dir):
    """The investigation report: newest 2000 duplicated keys (top-k is the feature)."""
    return find_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], limit=2000)


def _lines_in_batches(spark, sf_dir):
    """All line items, added in three batches by ship date, with their key and its uniqueness kept."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    path = scratch_path(spark, "lines")
    year = F.year("l_shipdate")
    for part in (year < 1995, year.between(1995, 1996), (year > 1996) | year.isNull()):
        append_unique(path, lines.where(part), ["l_orderkey", "l_linenumber"])
    return path


@register("kept_unique_report", """
SELECT 'lineitem' AS table_name, 'unique' AS rule, 'l_orderkey,l_linenumber' AS columns, count(*) AS violations FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
""")
def kept_unique_report(spark, sf_dir):
    """Key violations of a table that grew in batches, from the record kept beside it."""
    return unique_report(spark, _lines_in_batches(spark, sf_dir), "lineitem")


@register("kept_duplicate_keys", """
SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def kept_duplicate_keys(spark, sf_dir):
    """The repeated keys of the same table, without reading it."""
    return repeated_keys(spark, _lines_in_batches(spark, sf_dir))
