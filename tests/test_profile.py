import pytest

from shelfwise.operators import profile
from shelfwise.operators.joins import salted_join
from shelfwise.sources import tables as sources


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", 1.5), (2, "a", float("nan")), (2, None, None), (None, "b", 4.5)]
    return spark.createDataFrame(rows, "id int, name string, v double")


def test_schema_and_missing_values(df):
    assert [(r.position, r.column, r.type) for r in profile.describe_schema(df).collect()] == [
        (1, "id", "int"), (2, "name", "string"), (3, "v", "double"),
    ]
    assert {r.column: r.nulls for r in profile.null_counts(df).collect()} == {"id": 1, "name": 1, "v": 2}
    assert profile.numeric_columns(df) == ["id", "v"]


def test_distinct(df):
    assert {r.name for r in profile.distinct_values(df, "name").collect()} == {"a", "b", None}
    assert profile.n_distinct(df, "id").first()[0] == 2
    assert profile.n_distinct(df, "id", exact=False).first()[0] == 2


def test_counts(df):
    assert {r["table"]: r.rows for r in profile.table_counts({"x": df, "y": df.limit(1)}).collect()} == {"x": 4, "y": 1}
    assert [tuple(r) for r in profile.value_counts(df, "name", 1).collect()] == [("a", 2)]
    assert [tuple(r) for r in profile.key_violations(df, ["id"]).collect()] == [(2, 2)]


def test_describe_against_a_data_frame_library(tables):
    invoices = tables["vendor_invoice"]
    want = invoices.select("Quantity", "Freight").toPandas().astype(float).describe()
    for row in profile.describe(invoices, ["Quantity", "Freight"]).collect():
        got = [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
        assert got == pytest.approx(want[row["column"]].tolist())


def test_salted_join_equals_join(spark):
    left = spark.range(1000).selectExpr("id % 3 AS k", "id AS v").unionByName(
        spark.createDataFrame([(None, 5), (9, 6)], "k long, v long")
    )
    right = spark.createDataFrame([(0, "x"), (1, "y"), (7, "z")], "k long, t string")
    for how in ("inner", "left"):
        got = salted_join(left, right, "k", ["v"], how, 4)
        assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).collect()))


def test_catalog_tables(spark, df, tmp_path):
    place = str(tmp_path / "kept")
    sources.ensure_table(spark, "kept", df.schema, place)
    df.write.insertInto("kept")
    again = sources.ensure_table(spark, "kept", df.schema, place)
    assert again.count() == 4 and sources.scan_table(spark, "kept").dtypes == df.dtypes
    assert "kept" in {r["table"] for r in sources.list_tables(spark).collect()}
    spark.sql("DROP TABLE kept")


def test_replace_target(spark, df, tmp_path):
    target = str(tmp_path / "out")
    sources.write_table(df, target)
    sources.write_table(df.limit(2), target)
    assert sources.read_target(spark, target).count() == 2
    assert [r.id for r in sources.head(df, ["id"], 2).collect()] == [None, 1]
    assert sources.head(df, n=3).count() == 3
    assert sources.key_rows(df, 2, "id").count() == 2
