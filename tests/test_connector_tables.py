
import pytest
from pyspark.sql import types as T

from drawlake.operators.connector import mask_columns, sensitivity_of, sparse_nonnull, with_sensitivity, xml_values
from drawlake.schemas import DRAW_TABLE_SCHEMA
from drawlake.sources.sinks import ConstraintError, ensure_table, insert_rows, table_constraints, table_report, truncate_table


def test_sparse_nonnull(spark):
    df = spark.createDataFrame([(1, "a", None, 3.5), (2, None, None, None)], "id int, s string, t string, d double")
    got = sorted((r.id, r.column_name, r.value) for r in sparse_nonnull(df, ["id"], ["s", "t", "d"]).collect())
    assert got == [(1, "d", "3.5"), (1, "s", "a")]


def test_labels_and_masking(spark):
    df = spark.createDataFrame([(1, "Alice Smith 42")], "id int, name string")
    labelled = with_sensitivity(df, {"name": {"label": "Confidential", "information_type": "Name"}})
    assert sensitivity_of(labelled) == {"name": {"label": "Confidential", "information_type": "Name"}}
    assert mask_columns(labelled).first().name == "Xxxxx Xxxxx nn"


def test_xml_values(spark):
    df = spark.createDataFrame([(1, "<draw><date>2021-10-12</date><ball>6</ball></draw>")], "id int, doc string")
    r = xml_values(df, "doc", {"d": "/draw/date", "b": "/draw/ball"}).first()
    assert (r.d, r.b) == ("2021-10-12", "6")


def test_ensure_and_truncate_table(spark):
    name = "drawlake_test_draws"
    ensure_table(spark, name, DRAW_TABLE_SCHEMA, replace=True, comment="draw history")
    assert spark.table(name).count() == 0
    cols = {f.name: f for f in spark.table(name).schema.fields}
    assert set(cols) == {f.name for f in DRAW_TABLE_SCHEMA.fields}
    spark.createDataFrame([(1, __import__("datetime").date(2004, 2, 13), 1, 2, 3, 4, 5, 1, 2, None, None)],
                          DRAW_TABLE_SCHEMA).write.insertInto(name)
    assert spark.table(name).count() == 1
    ensure_table(spark, name, DRAW_TABLE_SCHEMA)          # exists: untouched
    assert spark.table(name).count() == 1
    truncate_table(spark, name)
    assert spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_scalar_select_without_table(spark):
    # A table-less select is plain spark.sql; no library code needed.
    assert spark.sql("SELECT trim(date_format(DATE'2004-01-01', 'EEEE')) AS d").first().d == "Thursday"


def test_constraints_belong_to_the_table(spark):
    name = "drawlake_test_keys"
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d's", T.StringType()), T.StructField("v", T.IntegerType(), False)])
    ensure_table(spark, name, schema, replace=True, primary_key=["k"], unique=[["d's"], ["d's", "v"]])
    try:
        assert table_constraints(spark, name) == {"not_null": ["k", "v"], "unique": [["k"], ["d's"], ["d's", "v"]]}
        rows = lambda *r: spark.createDataFrame(list(r), "v int, k int, `d's` string")
        insert_rows(spark, name, rows((1, 10, "a"), (2, 20, "b")))
        insert_rows(spark, name, spark.sql("SELECT 30 AS k, 5 AS v"))  # a literal row without one column
        held = lambda: sorted(map(tuple, spark.table(name).collect()))
        want = [(10, "a", 1), (20, "b", 2), (30, None, 5)]
        assert held() == want
        for bad, rule in (
                (rows((1, None, "z")), r"not_null \(k\): 1"),
                (rows((1, 40, "x"), (2, 40, "y")), r"unique \(k\): 1"),
                (rows((1, 10, "q"), (1, 20, "r"), (1, 50, "s")), r"already held \(k\): 2"),
                (rows((9, 60, None)), r"already held \(d's\): 1"),  # null meets null
                (spark.sql("SELECT 70 AS k"), r"not_null \(v\): 1")):
            with pytest.raises(ConstraintError, match=rule):
                insert_rows(spark, name, bad)
            assert held() == want
        with pytest.raises(ValueError, match="no column"):
            insert_rows(spark, name, rows((1, 80, "h")).withColumnRenamed("v", "w"))
        insert_rows(spark, name, rows((1, 90, "i")).limit(0))
        rows((3, 10, "a")).select("k", "d's", "v").write.insertInto(name)  # past the check
        assert {(r.rule, r["columns"]): r.violations for r in table_report(spark, name).collect()} == {
            ("not_null", "k"): 0, ("not_null", "v"): 0, ("unique", "k"): 1, ("unique", "d's"): 1, ("unique", "d's,v"): 0}
        with pytest.raises(ValueError, match="no column"):
            ensure_table(spark, name + "_2", schema, unique=[["nope"]])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_table_without_declared_constraints(spark):
    spark.sql("DROP TABLE IF EXISTS drawlake_test_plain")
    spark.sql("CREATE TABLE drawlake_test_plain (k INT) USING parquet")
    insert_rows(spark, "drawlake_test_plain", spark.createDataFrame([(None,), (None,)], "k int"))
    assert spark.table("drawlake_test_plain").count() == 2 and table_report(spark, "drawlake_test_plain").count() == 0
    spark.sql("DROP TABLE drawlake_test_plain")
