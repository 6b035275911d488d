"""Sensitivity labels follow values through a query."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from drawlake.operators.connector import derived_sensitivity, mask_derived, sensitivity_of, with_sensitivity

NAME, PAY = {"label": "Confidential", "information_type": "Name"}, {"label": "Highly Confidential", "information_type": "Pay"}


@pytest.fixture
def people(spark):
    df = spark.createDataFrame([(1, "Ann", 10, "x"), (2, "Bob", 20, "y")], "id int, name string, pay int, town string")
    return with_sensitivity(df, {"name": NAME, "pay": PAY})


def labelled(df):
    return {c: v["label"] for c, v in derived_sensitivity(df).items()}


def test_expressions_and_joins(spark, people):
    towns = spark.createDataFrame([("x", "North"), ("y", "South")], "town string, part string")
    df = (people.withColumnRenamed("name", "who").join(towns, "town").where("pay > 5")
          .select("id", "part", F.col("who").alias("w"), F.concat("part", "who").alias("both"), (F.col("pay") + F.col("id")).alias("sum"),
                  F.struct("town", "pay").alias("s"), F.length(F.lit("abc")).alias("c"),
                  F.concat_ws("-", "who", F.col("pay").cast("string")).alias("mix")))
    assert labelled(df) == {"w": "Confidential", "both": "Confidential", "sum": "Highly Confidential",
                            "s": "Highly Confidential", "mix": "Highly Confidential"}
    assert derived_sensitivity(df)["mix"]["information_type"] == "Name, Pay"
    masked = mask_derived(df)
    got = {r.id: r for r in masked.collect()}
    assert (got[1].part, got[1].w, got[1].both, got[1]["sum"], got[1].s, got[1].c, got[1].mix) == \
        ("North", "Xxx", "XxxxxXxx", None, None, 3, "Xxx-nn")
    assert set(sensitivity_of(masked)) == set(labelled(df))
    high = mask_derived(df, least="Highly Confidential").where("id = 1").first()
    assert (high.w, high.mix) == ("Ann", "Xxx-nn")


def test_aggregates_windows_unions_generators_self_joins(spark, people):
    assert labelled(people.groupBy("town").agg(F.max("name").alias("m"), F.count("*").alias("n"), F.sum("id").alias("i"))) == {"m": "Confidential"}
    assert labelled(people.groupBy("name").count()) == {"name": "Confidential"}
    w = Window.partitionBy("town").orderBy("id")
    assert labelled(people.select("id", F.lag("pay").over(w).alias("before"), F.row_number().over(w).alias("r"))) == {"before": "Highly Confidential"}
    plain = spark.createDataFrame([("a", "b")], "p string, q string")
    assert labelled(plain.union(people.select("town", "name"))) == {"q": "Confidential"}
    assert labelled(people.select("id", F.explode(F.split("name", "")).alias("letter"))) == {"letter": "Confidential"}
    a, b = people.select("id", F.upper("name").alias("u")), people.select(F.col("id").alias("id2"), F.lower("name").alias("l"), "town")
    assert labelled(a.join(b, F.col("id") == F.col("id2"))) == {"u": "Confidential", "l": "Confidential"}
    people.createOrReplaceTempView("labelled_people")
    sql = spark.sql("SELECT town, (SELECT max(name) FROM labelled_people) AS top, 1 AS one FROM labelled_people")
    assert labelled(sql) == {"top": "Confidential"}


def test_python_functions_files_and_nothing_labelled(spark, people, tmp_path):
    def same(parts):
        for p in parts:
            yield pd.DataFrame({"t": p["town"]})
    assert labelled(people.mapInPandas(same, "t string")) == {"t": "Highly Confidential"}  # may hold any input
    people.write.parquet(str(tmp_path / "p"))
    assert labelled(spark.read.parquet(str(tmp_path / "p")).select(F.upper("name").alias("n"), "id")) == {"n": "Confidential"}
    assert labelled(people.select("id", "town")) == {} and mask_derived(people.select("id", "town")).count() == 2
