import pytest

from shelfwise.operators.aggregates import order_by_total_purchases, order_by_total_sales
from shelfwise.operators.metrics import (
    profitable,
    with_order_size,
    with_unit_price,
    with_unsold_value,
)
from shelfwise.plans import questions as q

COLUMNS = (
    "VendorName string, Description string, TotalPurchaseDollars double, GrossProfit double, TotalSalesDollars double, "
    "ProfitMargin double, StockTurnover double, TotalPurchaseQuantity double, TotalSalesQuantity double, PurchasePrice double"
)
ROWS = [
    ("A", "p1", 500.0, 100.0, 600.0, 16.67, 0.5, 100.0, 50.0, 5.0),
    ("A", "p2", 100.0, 20.0, 120.0, 20.0, 0.9, 10.0, 9.0, 10.0),
    ("B", "p1", 250.0, 50.0, 300.0, 10.0, 1.5, 50.0, 75.0, 5.0),
    ("C", "p3", 100.0, 300.0, 400.0, 75.0, 0.7, 20.0, 14.0, 5.0),
    ("D", "p4", 50.0, 30.0, 80.0, 90.0, 0.2, 5.0, 1.0, 10.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def test_profitable_drops_losses_and_missing_margins(spark):
    data = [(1.0, 5.0, 2.0), (-1.0, 5.0, 2.0), (1.0, None, 2.0), (1.0, 5.0, 0.0)]
    df = spark.createDataFrame(data, "GrossProfit double, ProfitMargin double, TotalSalesQuantity double")
    assert profitable(df).count() == 1


def test_target_brands(rows):
    """Sales 80, 120, 400, 900 have the 15 % point 98; margins 13.335, 20, 75, 90 the 85 % point 83.25."""
    assert [r.Description for r in q.target_brands(rows).collect()] == ["p4"]
    scatter = q.brand_scatter(rows, 500).collect()
    assert {r.Description: r.IsTarget for r in scatter} == {"p2": False, "p3": False, "p4": True}
    assert [r.LowSalesThreshold for r in scatter] == pytest.approx([98.0] * 3)
    assert [r.HighMarginThreshold for r in scatter] == pytest.approx([83.25] * 3)


def test_top_lists(rows):
    got = q.top_vendors(rows, 3).collect()
    assert [(r.VendorName, r.TotalSalesDollars) for r in got] == [("A", 720.0), ("C", 400.0), ("B", 300.0)]
    brands = q.top_brands(rows, 2).collect()
    assert [(r.Description, r.SalesText) for r in brands] == [("p1", "900.0"), ("p3", "400.0")]


def test_ties_fall_to_the_first_key(spark):
    data = [("b", 5.0), ("a", 5.0), ("c", 9.0), (None, 99.0)]
    df = spark.createDataFrame(data, "VendorName string, TotalSalesDollars double")
    assert [r.VendorName for r in q.top_vendors(df, 2).collect()] == ["c", "a"]


def test_contribution_and_pareto(rows):
    """Purchases of 1000 in all: 600, 250, 100 and 50."""
    got = q.purchase_contribution(rows).collect()
    assert [(r.VendorName, r[q.SHARE]) for r in got] == [("A", 60.0), ("B", 25.0), ("C", 10.0), ("D", 5.0)]
    running = [r[q.RUNNING_SHARE] for r in q.pareto(rows, 3).collect()]
    assert running == pytest.approx([60.0, 85.0, 95.0])
    assert q.contribution_total(rows, 2).first()[0] == pytest.approx(85.0)
    other = q.contribution_with_other(rows, 2).collect()
    assert [(r.VendorName, r[q.SHARE]) for r in other] == [("A", 60.0), ("B", 25.0), (q.OTHER, 15.0)]


def test_slow_vendors_and_locked_capital(rows):
    """Unsold: A 50 at 5 and 1 at 10, B -25 at 5, C 6 at 5, D 4 at 10."""
    slow = q.slow_vendors(rows, 5).collect()
    assert [r.VendorName for r in slow] == ["D", "A", "C"]
    assert [r.StockTurnover for r in slow] == pytest.approx([0.2, 0.7, 0.7])
    total = q.total_locked_capital(rows).first()
    assert (total.UnsoldInventoryValue, total.UnsoldInventoryText) == (205.0, "205.0")
    assert [r.VendorName for r in q.locked_capital(rows, 2).collect()] == ["A", "D"]


def test_kpis(rows):
    row = q.kpis(rows).first()
    assert (row.TotalSales, row.TotalPurchases, row.GrossProfit) == (1500.0, 1000.0, 500.0)
    assert row.AvgProfitMargin == pytest.approx(42.334)


def test_unit_price_and_unsold_value(spark):
    df = spark.createDataFrame([(10.0, 4.0, 6.0, 2.5), (3.0, 0.0, 1.0, 3.0)],
        "TotalPurchaseDollars double, TotalPurchaseQuantity double, TotalSalesQuantity double, PurchasePrice double")
    got = with_unsold_value(with_unit_price(df)).collect()
    assert got[0].UnitPurchasePrice == 2.5 and got[1].UnitPurchasePrice == float("inf")
    assert [r.UnsoldInventoryValue for r in got] == [-5.0, -3.0]


def sizes(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "TotalPurchaseQuantity double")
    return {r[0]: r.OrderSize for r in with_order_size(df).collect()}


def test_order_size_keeps_ties_together(spark):
    """The third points of these ten values are 2 and 3."""
    got = sizes(spark, [1, 1, 2, 2, 2, 3, 3, 4, 5, 6])
    assert got == {1: "Small", 2: "Small", 3: "Medium", 4: "Large", 5: "Large", 6: "Large"}


def test_order_size_refuses_equal_edges(spark):
    with pytest.raises(Exception, match="not distinct"):
        sizes(spark, [1, 1, 1, 1, 2])


def test_unit_price_by_order_size(rows):
    """Quantities 5 and 10 are small, 20 medium, 50 and 100 large."""
    got = {r.OrderSize: r.UnitPurchasePrice for r in q.unit_price_by_order_size(rows).collect()}
    assert got == pytest.approx({"Small": 10.0, "Medium": 5.0, "Large": 5.0})


def test_ordered_totals(spark):
    bought = spark.createDataFrame(
        [(2, 7, 10.0), (1, 9, 10.0), (1, 3, 10.0), (5, 1, 99.0)],
        "VendorNumber bigint, Brand bigint, TotalPurchaseDollars double",
    )
    assert [(r[0], r[1]) for r in order_by_total_purchases(bought).collect()] == [(5, 1), (1, 3), (1, 9), (2, 7)]
    sold = bought.withColumnRenamed("TotalPurchaseDollars", "TotalSalesDollars")
    assert [(r[0], r[1]) for r in order_by_total_sales(sold).collect()] == [(5, 1), (1, 3), (1, 9), (2, 7)]
