"""Joins that copy the right side for hot keys only."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.joins import HOT_SHARE, copies, hot_keys, salted_join
from shelfwise.plans.summary import vendor_summary


@pytest.fixture(scope="module")
def sides(spark):
    """Key 7 and the null key hold a third of the left rows each, key 11 one of 50; right has one row for each key."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN null WHEN id % 50 = 2 THEN 11 ELSE pmod(hash(id), 5000) END")
    left = spark.range(0, 120_000, 1, 6).select(key.cast("int").alias("k"), F.col("id").alias("v"))
    right = spark.range(6000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right


def hot_of(left):
    (hot,) = hot_keys(left, ["k"])
    return hot


def test_hot_keys_are_found(spark, sides):
    left, right = sides
    counts = {r.k: r["count"] for r in left.groupBy("k").count().collect()}
    found = right.where(F.array_contains(hot_of(left), F.xxhash64("k"))).collect()
    assert {r.k for r in found} == {k for k, n in counts.items() if k is not None and n > HOT_SHARE * 120_000} == {7, 11}


def test_only_hot_rows_are_copied(sides):
    left, right = sides
    rows = copies(right, ["k"], 8, hot_of(left)).groupBy("k").count().where("count > 1").collect()
    assert {(r.k, r["count"]) for r in rows} == {(7, 8), (11, 8)}
    assert copies(right, ["k"], 8).count() == 8 * 6000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equal_to_the_plain_join(sides, how):
    left, right = sides
    joined = salted_join(left, right, "k", ["v"], how, hot=hot_of(left))
    assert joined.columns == ["k", "v", "w"]
    want = left.join(right, "k", how)
    assert joined.exceptAll(want).count() == 0 == want.exceptAll(joined).count()


def test_no_task_gets_a_hot_key_whole(spark, sides):
    """Partitions of the shuffle under the join, without broadcasts and without adaptive splitting."""
    left, right = sides
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        known = left.where("k IS NOT NULL")
        plain = known.join(right, "k").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        joined = salted_join(known, right, "k", ["v"], "inner", hot=hot_of(known))
        most = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plain > 40_000 and most < 20_000


def test_summary_copies_hot_keys_only(tables):
    plan = vendor_summary(tables["purchases"], tables["purchase_prices"], tables["sales"], tables["vendor_invoice"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" in text and "array_contains" in text.lower()
    assert "CartesianProduct" not in plan._jdf.queryExecution().executedPlan().toString()
