import os

import pytest
from pyspark.sql import functions as F

from drawlake.functions import day_name, is_weekday, mon_date_text, money_to_decimal, split_codes
from drawlake.operators.standardize import (
    align_columns, lower_case_columns, require_columns, split_valid, standardize, tolerant_int,
    union_aligned,
)
from drawlake.sources.files import read_csv_table, read_export_json, read_scraped, read_source1, read_source2
from drawlake.sources.jdbc import jdbc_url, read_jdbc_table, write_jdbc_table
from drawlake.sources.sinks import export_table

# Small literal copies of the source shapes (see FIXTURES.md A1-A6).
SRC1_V1 = """DrawDate,Ball 1,Ball 2,Ball 3,Ball 4,Ball 5,Lucky Star 1,Lucky Star 2,UK Millionaire Maker,DrawNumber
04-Mar-2031,3,9,27,31,44,2,8,"QAAA00001",9002
28-Feb-2031,5,6,7,8,9,1,4,"QBBB00002,QCCC00003,QDDD00004",9001
"""
SRC1_V2 = """DrawDate,Ball 1,Ball 2,Ball 3,Ball 4,Ball 5,Lucky Star 1,Lucky Star 2,UK Millionaire Maker,European Millionaire Maker,DrawNumber
11-Apr-2031,10,20,30,40,44,3,9,"QEEE00005","",9014
08-Apr-2031,12,14,16,18,20,5,6,"QFFF00006","QGGG",9013
"""
SRC2 = """Date;N1;N2;N3;N4;N5;E1;E2;Winner;Gain
2030-01-04;2;3;5;7;41;1;6;0;0
2030-01-08;11;13;17;19;23;2;9;1;100
"""
SCRAPED = """draw_date,ball_1,ball_2,ball_3,ball_4,ball_5,lucky_star_1,lucky_star_2,jackpot,winners
2031-03-04,6,9,27,31,44,2,8,"£12,345,678",
2031-02-28,5,6,7,8,9,1,4,,2
"""


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_source1_two_layouts(spark, tmp_path):
    a = _write(tmp_path, "a.csv", SRC1_V1)
    b = _write(tmp_path, "b.csv", SRC1_V2)
    df = read_source1(spark, [a, b])
    rows = {r.draw_number: r for r in df.collect()}
    assert set(df.columns) >= {"draw_date", "ball_1", "lucky_star_2", "uk_millionaire_maker", "draw_number"}
    assert "European Millionaire Maker" not in df.columns
    assert str(rows[9002].draw_date) == "2031-03-04" and rows[9014].ball_5 == 44
    assert rows[9001].uk_millionaire_maker == "QBBB00002,QCCC00003,QDDD00004"
    codes = df.select(split_codes("uk_millionaire_maker").alias("c")).where(F.size("c") == 3).count()
    assert codes == 1


def test_source1_reads_all_files_in_one_scan(spark, tmp_path):
    for i in range(6):
        _write(tmp_path, f"f{i}.csv", (SRC1_V1 if i % 2 else SRC1_V2).replace("90", f"9{i}"))
    df = read_source1(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 and "Union" not in plan
    assert sorted(r.draw_number for r in df.collect()) == sorted(
        9000 + 100 * i + n for i in range(6) for n in ((1, 2) if i % 2 else (13, 14)))
    # pruned to one column, and past the ends of both layouts
    assert df.select("draw_number").where("draw_number is null").count() == 0
    odd = SRC1_V2 + '04-Apr-2031,1,x,3,4,5,,2,"",,\n01-Apr-2031,1,2\n\n'
    rows = {str(r.draw_date): r for r in read_source1(spark, [_write(tmp_path, "odd.csv", odd)]).collect()}
    assert rows["2031-04-04"].ball_2 is None and rows["2031-04-04"].lucky_star_1 is None and rows["2031-04-04"].draw_number is None
    assert rows["2031-04-01"].ball_2 == 2 and rows["2031-04-01"].ball_3 is None and len(rows) == 4
    assert read_source1(spark, [_write(tmp_path, "none.csv", SRC1_V1.splitlines()[0] + "\n")]).count() == 0


def test_csv_export_doubles_quotes_and_parts_by_any_sign(spark, tmp_path):
    rows = [(1, 'a "b"; c'), (2, None), (3, "x,y"), (4, "back\\slash")]
    for sep in (",", ";"):
        out = str(tmp_path / f"out{ord(sep)}")
        export_table(spark.createDataFrame(rows, "k int, s string"), out, sep=sep)
        assert sorted(map(tuple, read_csv_table(spark, out, schema="k int, s string", sep=sep).collect())) == rows


def test_source2_and_scraped(spark, tmp_path):
    df = read_source2(spark, _write(tmp_path, "s2.csv", SRC2))
    r = df.orderBy("draw_date").first()
    assert r.load_number == 2 and r.ball_5 == 41 and "Winner" not in df.columns
    sc = read_scraped(spark, _write(tmp_path, "sc.csv", SCRAPED))
    rows = sc.orderBy("draw_date").collect()
    assert rows[0].jackpot is None and rows[0].winners == "2" and rows[1].ball_1 == "6"
    assert sc.select(money_to_decimal("jackpot").alias("m")).where("m is not null").first().m == 12345678


def test_json_roundtrip_and_empty_guard(spark, tmp_path):
    src = spark.createDataFrame([("2031-03-04T00:00:00.000", 1, 6, 9, 27, 31, 44, 2, 8, None, None)],
                                "DRAW_DATE string, DRAW_NUMBER long, BALL_1 long, BALL_2 long, BALL_3 long, "
                                "BALL_4 long, BALL_5 long, LUCKY_STAR_1 long, LUCKY_STAR_2 long, JACKPOT string, WINNERS long")
    out = str(tmp_path / "json")
    assert export_table(src, out, "json")
    back = read_export_json(spark, out)
    r = back.first()
    assert str(r.draw_date) == "2031-03-04" and r.ball_1 == 6 and r.jackpot is None
    assert not export_table(src.limit(0), str(tmp_path / "empty"), "csv")
    assert not os.path.exists(str(tmp_path / "empty"))


def test_jdbc_derby_roundtrip(spark):
    url = "jdbc:derby:memory:drawlake_t;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(0, 100).select(F.col("id").cast("int").alias("DRAW_NUMBER"), (F.col("id") % 50 + 1).cast("int").alias("BALL_1"))
    write_jdbc_table(df, url, "DRAWS", mode="overwrite", driver=driver)
    write_jdbc_table(df.limit(10), url, "DRAWS", mode="append", driver=driver)
    back = read_jdbc_table(spark, url, "DRAWS", driver=driver, partition_column="DRAW_NUMBER",
                           lower_bound=0, upper_bound=100, num_partitions=3, fetchsize=10)
    assert back.rdd.getNumPartitions() == 3 and back.count() == 110
    q = read_jdbc_table(spark, url, query="SELECT * FROM DRAWS WHERE BALL_1 = 1", driver=driver)
    assert q.count() == 2 + 1
    assert jdbc_url("postgresql://u:p@h:5432/db?sslmode=require") == (
        "jdbc:postgresql://h:5432/db", {"sslmode": "require", "user": "u", "password": "p"})


def test_standardize_and_checks(spark):
    df = spark.createDataFrame([("2031-03-04 13:45:00", "7", "1", "2", "3", "4", "5.0", "x", "12")],
                               "DRAW_DATE string, DRAW_NUMBER string, BALL_1 string, BALL_2 string, BALL_3 string, "
                               "BALL_4 string, BALL_5 string, LUCKY_STAR_1 string, LUCKY_STAR_2 string")
    r = standardize(df).first()
    assert str(r.draw_date) == "2031-03-04" and r.ball_5 == 5 and r.lucky_star_1 is None and r.lucky_star_2 == 12
    with pytest.raises(KeyError):
        require_columns(df, ["nope"])
    with pytest.raises(ValueError):
        lower_case_columns(spark.createDataFrame([(1, 2)], "a int, A int"))
    vals = spark.createDataFrame([("12",), (" 3 ",), ("12.5",), ("x",), (None,), ("99999999999",)], "s string")
    assert [r.v for r in vals.select(tolerant_int("s").alias("v")).collect()] == [12, 3, None, None, None, None]


def test_align_union_split(spark):
    a = spark.createDataFrame([(1, "x")], "Key int, Val string")
    b = spark.createDataFrame([(2, "y", "z")], "Key int, Val string, Extra string")
    u = union_aligned([align_columns(a, lower=True), align_columns(b, lower=True, constants={"load_number": 2})])
    rows = {r.key: r for r in u.collect()}
    assert rows[1].extra is None and rows[2].extra == "z" and rows[1].load_number is None
    good, bad = split_valid(u, {"has_extra": F.col("extra").isNotNull(), "positive": F.col("key") > 0})
    assert [r.key for r in good.collect()] == [2]
    assert [(r.key, r._reason) for r in bad.collect()] == [(1, "has_extra")]


def test_calendar_functions(spark):
    df = spark.createDataFrame([("2004-01-01",)], "d string").select(F.to_date("d").alias("d"))
    r = df.select(day_name("d").alias("n"), mon_date_text("d").alias("t"),
                  is_weekday("d", "Thursday").alias("w")).first()
    assert (r.n, r.t, r.w) == ("Thursday", "2004-JAN-01", True)
