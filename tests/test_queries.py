"""Every registered query against its SQL twin in DuckDB."""

import re
from numbers import Number

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

# Queries of the optional subpackage have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", k)}
BASE = ("supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def ordered(df: pd.DataFrame) -> list[tuple]:
    """Rows with cells in column-name order: text first in the sort, then numbers."""
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False, name=None)]

    def key(row):
        text = [str(v) for v in row if not isinstance(v, Number)]
        return text, [round(float(v), 4) for v in row if isinstance(v, Number)]

    return sorted(rows, key=key)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = result.toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert set(got.columns) == set(want.columns)
    assert len(got) > 0
    for c in got.columns:
        if pd.api.types.is_datetime64_any_dtype(want[c]):
            want[c] = want[c].dt.date
    for mine, theirs in zip(ordered(got), ordered(want), strict=True):
        for a, b in zip(mine, theirs, strict=True):
            number = isinstance(a, Number) and isinstance(b, Number)
            assert a == (pytest.approx(b, rel=1e-9, abs=2e-6) if number else b)


@pytest.mark.parametrize("name", ["purchase_summary_max_ordered", "sales_summary_ordered"])
def test_order(spark, duck, name):
    """The rows come in the order of the twin."""
    got = QUERIES[name](spark, SMALL).toPandas()[["VendorNumber", "Brand"]]
    want = duck.execute(ORACLES[name]).df()[["VendorNumber", "Brand"]]
    assert len(got) > 100 and got.astype(int).values.tolist() == want.astype(int).values.tolist()


def test_filters_drop_some_rows(spark):
    def rows(name):
        return QUERIES[name](spark, SMALL).count()

    assert 0 < rows("profitable_rows") < rows("clean_summary")
    assert 0 < rows("vendor_rows_sales") < rows("scan_sales")
    assert 0 < rows("capped_brands") < rows("brand_performance")
    assert rows("strict_summary") < rows("clean_summary")


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() == 200 and len(result.columns) == 18
