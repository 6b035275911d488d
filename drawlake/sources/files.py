"""CSV and JSON-lines sources (O1-O4) with declared schemas.

Schemas are declared rather than inferred: inference costs a full extra pass
over the input and can change type from one file to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.functions.dates import DMY_ABBR, ISO_DATE, parse_date
from drawlake.operators.standardize import align_columns, lower_case_columns
from drawlake.schemas import (
    EXPORT_JSON_SCHEMA, SCRAPED_COLUMNS, SOURCE1_RENAMES, SOURCE1_V1_SCHEMA, SOURCE1_V2_SCHEMA,
    SOURCE2_RENAMES, SOURCE2_SCHEMA,
)


def read_csv_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
                   sep: str = ",", header: bool = True, all_strings: bool = False,
                   null_value: str = "", mode: str = "PERMISSIVE",
                   columns: Sequence[str] | None = None, corrupt_col: str | None = None) -> DataFrame:
    """CSV with header; quoted cells may hold separators (multi-code cells) (O1-O3).

    ``all_strings`` reads every column as text (``columns`` names them when no
    schema is given); empty cells become null. ``corrupt_col`` holds the raw
    text of lines that have more or fewer cells than the schema, else null.
    """
    if schema is None and all_strings:
        if columns is None:
            raise ValueError("all_strings needs the column names (or a schema)")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = (spark.read.option("header", header).option("sep", sep).option("quote", '"')
                   .option("escape", '"').option("multiLine", False)
                   .option("nullValue", null_value).option("mode", mode))
    if corrupt_col:
        if schema is None:
            raise ValueError("corrupt_col needs a schema or the column names")
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        # cells are counted only where the parser splits whole lines
        r = r.option("columnNameOfCorruptRecord", corrupt_col).option("columnPruning", False)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path if isinstance(path, str) else list(path))


def read_json_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                    lower: bool = True, corrupt_col: str | None = None) -> DataFrame:
    """JSON lines with a declared schema (O4); keys lower-cased.

    ``corrupt_col`` keeps unparsable lines as raw text in that column
    (PERMISSIVE mode) instead of dropping them.
    """
    s = schema
    r = spark.read.option("mode", "PERMISSIVE")
    if corrupt_col:
        s = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    df = r.schema(s).json(path if isinstance(path, str) else list(path))
    return lower_case_columns(df) if lower else df


def read_source1(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Source-1 draw history files of both layouts in one scan.

    All files (or folders) are read with the names of the wider layout. A line
    that ends one cell early is of the narrower one, so its cells are named by
    that; no header is looked at, however many files there are. Columns are
    renamed to the warehouse names, the extra column is dropped, and
    ``dd-MMM-yyyy`` dates are parsed; a cell that is no number becomes null.
    """
    narrow, wide = SOURCE1_V1_SCHEMA.fields, SOURCE1_V2_SCHEMA.names
    lines = read_csv_table(spark, paths, all_strings=True, columns=wide, corrupt_col="_line")
    early = F.col("_line").isNotNull() & F.col(wide[-1]).isNull()
    cells = [F.when(early, F.col(at)).otherwise(F.col(f.name)).try_cast(f.dataType).alias(f.name)
             for f, at in zip(narrow, wide)]
    out = align_columns(lines.select(*cells), SOURCE1_RENAMES)
    return out.withColumn("draw_date", parse_date("draw_date", DMY_ABBR))


def read_source2(spark: SparkSession, path: str, load_number: int = 2) -> DataFrame:
    """Source-2 ``;`` file: winner/gain dropped, names aligned, provenance constant."""
    df = read_csv_table(spark, path, SOURCE2_SCHEMA, sep=";")
    out = align_columns(df, SOURCE2_RENAMES, drop=["Winner", "Gain"],
                        constants={"load_number": F.lit(load_number)})
    return out.withColumn("draw_date", parse_date("draw_date", ISO_DATE))


def read_scraped(spark: SparkSession, path: str) -> DataFrame:
    """Scraped CSV: all text, empty = null, then the date parsed from ``yyyy-MM-dd`` (O3)."""
    df = read_csv_table(spark, path, all_strings=True, columns=SCRAPED_COLUMNS)
    return df.withColumn("draw_date", parse_date("draw_date", ISO_DATE))


def read_export_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines export with upper-case keys to lower-case columns and a date."""
    df = read_json_table(spark, path, EXPORT_JSON_SCHEMA, lower=True)
    return df.withColumn("draw_date", F.to_date(F.try_to_timestamp(
        F.col("draw_date"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))))
