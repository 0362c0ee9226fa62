"""Clustered tables: look-ups by key read a small part of the row groups."""

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import csv_import as ci
from shelfwise.sources import tables


def rows_scanned(df):
    """Rows that the scan of files gave, before the filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows belong to vendor 7."""
    vendor = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(5000)))
    return spark.range(0, 400_000, 1, 8).select(
        vendor.cast("int").alias("VendorNumber"), F.pmod(F.hash("id", F.lit(2)), F.lit(90_000)).alias("Brand"),
        F.sha2(F.col("id").cast("string"), 256).alias("Description"),
    )


def test_look_ups_read_few_row_groups(spark, rows, tmp_path):
    plain, target = str(tmp_path / "plain"), str(tmp_path / "clustered")
    options = tables.layout_options(["VendorNumber", "Brand"], row_group=256 << 10, distinct=20_000)
    tables.write_table(rows, plain, options={"parquet.block.size": str(256 << 10)})
    tables.write_table(tables.clustered(rows, ["VendorNumber"]), target, options=options)
    for number in (5, 1234):
        want = sorted(tables.key_rows(spark.read.parquet(plain), number).collect())
        found = tables.key_rows(spark.read.parquet(target), number)
        assert sorted(found.collect()) == want and len(want) > 0
        assert rows_scanned(found) < 0.05 * 400_000 < 0.5 * rows_scanned(tables.key_rows(spark.read.parquet(plain), number))
    # the Bloom filter on a column that the table is not ordered by
    absent = spark.read.parquet(target).where("Brand = 95000 OR Brand = -4")
    assert rows_scanned(absent) == 0
    one = spark.read.parquet(target).where("Brand = 4321")
    assert rows_scanned(one) < 0.2 * 400_000 and one.count() == rows.where("Brand = 4321").count()


def test_a_hot_key_goes_to_several_partitions(rows):
    parts = tables.clustered(rows, ["VendorNumber"]).withColumn("p", F.spark_partition_id()).where("VendorNumber = 7")
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.25 * 400_000


def test_imported_tables_are_clustered(spark, tmp_path):
    spark.range(20_000).selectExpr("id % 400 AS VendorNumber", "id AS Brand", "CAST(id / 7 AS DECIMAL(12,2)) AS Dollars").write.option(
        "header", True
    ).csv(str(tmp_path / "purchases.csv"))
    report = ci.import_tables(spark, str(tmp_path), str(tmp_path / "out"), {"purchases.csv": "purchases"}).first()
    assert (report.status, report.rows, report.lost) == ("loaded", 20_000, 0)
    table = spark.read.parquet(str(tmp_path / "out" / "purchases"))
    ranges = table.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("VendorNumber").alias("a"), F.max("VendorNumber").alias("b"))
    ends = sorted((r.a, r.b) for r in ranges.collect())
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
    assert tables.key_rows(table, 33).count() == 50


def test_plain_replacement_and_options(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.write_table(spark.range(5), target, cluster_by=["id"])
    tables.write_table(spark.range(3), target)
    assert sorted(r.id for r in tables.read_target(spark, target).collect()) == [0, 1, 2]
