"""Reconcile by digests: the rows of the plain reconcile, and how little is shuffled."""

import random

import pytest
from pyspark.sql import functions as F

from drawlake.operators.digest import digests, reconcile_by_digest, summary_by_digest
from drawlake.operators.reconcile import reconcile, reconcile_summary


def rows(df):
    return sorted((tuple(r.asDict()[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def some(spark, seed, n, unique=False):
    rnd = random.Random(seed)
    keys = range(n) if unique else [rnd.choice([None, *range(n)]) for _ in range(n)]
    return spark.createDataFrame([(k, rnd.choice("xy"), rnd.choice([None, 0, 1]), float(rnd.randint(0, 1))) for k in keys],
                                 "k int, d string, v int, w double")


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("buckets,parts", [(4096, 64), (3, 2), (1, 1)])
def test_equals_reconcile(spark, strict, buckets, parts):
    left = some(spark, 1, 60)
    right = left.where("k is null or k % 9 <> 4").withColumn("v", F.when(F.col("k") % 13 == 5, F.lit(None).cast("int")).otherwise(F.col("v")))
    right = right.unionByName(some(spark, 2, 4).withColumn("k", F.col("k") + 100))
    for a, b in ((left, right), (left, left), (left, left.limit(0)), (left.limit(0), left.limit(0))):
        got = reconcile_by_digest(a, b.repartition(3), ["k", "d"], ["v", "w"], strict, buckets=buckets, parts=parts)
        assert rows(got) == rows(reconcile(a, b, ["k", "d"], ["v", "w"], strict))


def test_unique_keys_and_summary(spark):
    left = some(spark, 3, 300, unique=True)
    right = left.where("k <> 17").withColumn("w", F.when(F.col("k") == 40, 9.0).otherwise(F.col("w")))
    plain = reconcile(left, right, ["k"], ["d", "v", "w"])
    assert rows(reconcile_by_digest(left, right, ["k"], ["d", "v", "w"], unique_keys=True)) == rows(plain)
    assert rows(summary_by_digest(left, right, ["k"], ["d", "v", "w"])) == rows(reconcile_summary(plain))


def shuffled(df):
    """Rows that went through the exchanges of the final plan, from its metrics."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_only_differing_parts_are_shuffled(spark):
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    right = left.where("k <> 123").withColumn("v", F.when(F.col("k") == 9_000, F.lit(-1).cast("long")).otherwise(F.col("v")))
    few = shuffled(reconcile_by_digest(left, right, ["k"], ["v"], unique_keys=True))
    many = shuffled(reconcile(left, right, ["k"], ["v"]))
    assert many >= 39_000 and few < 50
    assert shuffled(reconcile_by_digest(left, left, ["k"], ["v"], unique_keys=True)) == 0


def test_digests_see_repeats_nulls_and_columns(spark):
    frame = lambda data: spark.createDataFrame(data, "a int, b int")
    of = lambda data: [tuple(r) for r in digests(frame(data).withColumn("g", F.lit(0)), ["a", "b"], ["g"]).collect()]
    assert of([(1, 2), (3, 4)]) == of([(3, 4), (1, 2)])
    different = [[(1, 2)], [(2, 1)], [(None, 1)], [(1, None)], [(None, None)], [(1, 2)] * 2, [(1, 2)] * 3, [(1, 2), (3, 4), (3, 4)]]
    assert len({str(of(d)) for d in different}) == len(different)
