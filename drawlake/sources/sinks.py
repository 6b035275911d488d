"""File exports and managed tables.

Exports go to a folder (one file per task), never through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.operators.reconcile import check_constraints

# Formats written by the reference exports.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CSV_DATE_FORMAT = "yyyy-MM-dd"
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
JSON_DATE_FORMAT = "yyyy-MM-dd'T00:00:00.000'"  # a date exports as its midnight


def export_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 skip_empty: bool = True, partition_by: Sequence[str] = (), sep: str = ",") -> bool:
    """Write ``df`` as CSV (header, no index, cells parted by ``sep``) or JSON lines; returns whether it wrote.

    With ``skip_empty`` an empty input writes nothing (O12); the check reads
    at most one row. JSON keeps null fields, as the pandas export does.
    """
    if skip_empty and df.isEmpty():
        return False
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        (w.option("header", True).option("sep", sep).option("escape", '"').option("timestampFormat", CSV_TIMESTAMP_FORMAT)
          .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
          .option("dateFormat", CSV_DATE_FORMAT).csv(path))
    elif fmt == "json":
        (w.option("timestampFormat", JSON_TIMESTAMP_FORMAT)
          .option("timestampNTZFormat", JSON_TIMESTAMP_FORMAT)
          .option("dateFormat", JSON_DATE_FORMAT)
          .option("ignoreNullFields", False).json(path))
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return True


#: Table property that holds the declared constraints.
CONSTRAINTS_PROPERTY = "drawlake.constraints"


class ConstraintError(ValueError):
    """Raised when rows would break a table's declared constraints."""


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, replace: bool = False,
                 comment: str | None = None, fmt: str = "parquet", primary_key: Sequence[str] = (),
                 unique: Sequence[Sequence[str]] = ()) -> None:
    """Create (or drop and re-create) an empty managed table from a declared schema.

    Column comments come from ``StructField.metadata['comment']``. NOT NULL
    columns (``nullable=False`` and the primary key), the key and further unique
    column sets are kept as a property of the table, where
    :func:`insert_rows` and :func:`table_report` find them.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if spark.catalog.tableExists(name):
        return
    unknown = {c for key in (primary_key, *unique) for c in key} - set(schema.names)
    if unknown:
        raise ValueError(f"the schema has no column {sorted(unknown)}")
    spark.catalog.createTable(name, schema=schema, source=fmt, description=comment)
    declared = {"not_null": [f.name for f in schema.fields if not f.nullable or f.name in primary_key],
                "unique": [list(key) for key in (primary_key, *unique) if key]}
    text = json.dumps(declared).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{CONSTRAINTS_PROPERTY}' = '{text}')")


def table_constraints(spark: SparkSession, name: str) -> dict:
    """The declared constraints of a table: ``not_null`` columns and ``unique`` column sets."""
    held = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == CONSTRAINTS_PROPERTY).first()
    return json.loads(held["value"]) if held else {"not_null": [], "unique": []}


def table_report(spark: SparkSession, name: str) -> DataFrame:
    """The constraint report (O36) of a table's declared constraints over the rows it holds."""
    return check_constraints(spark.table(name), name, **table_constraints(spark, name))


def insert_rows(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append rows, matched by column name, if they keep the declared constraints.

    Columns that ``rows`` lacks become null. Raises :class:`ConstraintError`
    naming each broken rule with its number of violations, and then writes
    nothing. Keys are compared with null equal to null, as in the report. The
    rows are planned once to check and once to write, so they should not
    change in between; two writers at a time are not kept apart.
    """
    table = spark.table(name)
    missing = [f for f in table.schema.fields if f.name not in rows.columns]
    extra = [c for c in rows.columns if c not in table.columns]
    if extra:
        raise ValueError(f"{name} has no column {extra}")
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*table.columns)
    declared = table_constraints(spark, name)
    report = check_constraints(rows, name, **declared)
    for key in declared["unique"]:
        batch, held = rows.select(*key).distinct().alias("b"), table.select(*key).alias("t")
        met = batch.join(held, [F.col(f"b.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key], "left_semi")
        report = report.unionByName(met.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("table_name"), F.lit("already held").alias("rule"), F.lit(",".join(key)).alias("columns"), "violations"))
    broken = report.where("violations > 0").collect()  # one row per rule at most
    if broken:
        raise ConstraintError(f"{name}: " + "; ".join(f"{r.rule} ({r.columns}): {r.violations}" for r in broken))
    rows.write.insertInto(name)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a managed table, keeping its definition."""
    spark.sql(f"TRUNCATE TABLE {name}")
