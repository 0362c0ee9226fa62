import pytest
from pyspark.sql import functions as F

from shelfwise.operators.aggregates import purchase_summary, purchase_summary_max
from shelfwise.operators.metrics import add_metrics, fill_numeric, trim_names
from shelfwise.operators.profile import key_violations
from shelfwise.plans.summary import (
    build_summary,
    clean_summary,
    fanout_summary,
    order_by_purchases,
    vendor_summary,
)

PURCHASES = (
    "VendorNumber int, VendorName string, Brand int, Description string, PurchasePrice decimal(12,2), "
    "Quantity int, Dollars decimal(12,2)"
)
PRICES = "VendorNumber int, Brand int, Price decimal(12,2), PurchasePrice decimal(12,2), Volume int"
SALES = (
    "VendorNo int, Brand int, SalesQuantity int, SalesPrice decimal(12,2), SalesDollars decimal(12,2), "
    "ExciseTax decimal(12,2)"
)
INVOICES = "VendorNumber int, PONumber int, Quantity int, Dollars decimal(12,2), Freight decimal(12,2)"


def frame(spark, rows, schema):
    """Rows with text amounts as a typed frame."""
    names = [part.split() for part in schema.split(", ")]
    raw = ", ".join(f"{n} {'string' if k.startswith('decimal') else k}" for n, k in names)
    return spark.createDataFrame(rows, raw).select(*[F.col(n).cast(k).alias(n) for n, k in names])


@pytest.fixture(scope="module")
def small(spark):
    """Two vendors of brand 1, one twice listed offer, a brand never sold, a free brand."""
    return {
        "purchases": frame(spark, [
            (1, " Acme ", 1, "Rum ", "2.00", 10, "20.00"),
            (1, " Acme ", 1, "Rum ", "2.00", 5, "10.00"),
            (2, "Bolt", 1, "Rum", "3.00", 4, "12.00"),
            (2, "Bolt", 2, "Gin", "4.00", 1, "4.00"),
            (1, " Acme ", 3, "Tea", "0.00", 9, "0.00"),
            (1, " Acme ", 4, "Ale", "1.00", 2, "2.00"),
        ], PURCHASES),
        "purchase_prices": frame(spark, [
            (1, 1, "5.00", "2.00", 750),
            (2, 1, "6.00", "3.00", 750),
            (2, 2, "9.00", "4.00", None),
            (1, 3, "1.00", "0.00", 1),
            (1, 4, "2.00", "1.00", 500),
            (1, 4, "2.00", "1.00", 500),
        ], PRICES),
        "sales": frame(spark, [
            (1, 1, 3, "5.00", "15.00", "0.30"),
            (1, 1, 4, "5.50", "22.00", "0.40"),
            (2, 1, 1, "6.00", "6.00", "0.10"),
            (1, 4, 1, "2.00", "2.00", "0.10"),
        ], SALES),
        "vendor_invoice": frame(spark, [(1, 7, 15, "30.00", "1.25"), (1, 8, 2, "2.00", "0.75")], INVOICES),
    }


def test_brand_join_repeats_a_purchase_per_offer(small):
    rows = purchase_summary(small["purchases"], small["purchase_prices"]).collect()
    by_offer = {(r.VendorNumber, r.Brand, float(r.ActualPrice)): r for r in rows}
    assert len(rows) == len(by_offer) == 6
    assert by_offer[(1, 1, 5.0)].TotalPurchaseQuantity == 15
    assert by_offer[(1, 1, 6.0)].TotalPurchaseQuantity == 15  # the other vendor's price
    assert by_offer[(1, 4, 2.0)].TotalPurchaseQuantity == 4  # offer listed twice
    assert (1, 3, 1.0) not in by_offer  # cost 0


def test_strict_join_keeps_vendors_apart(small):
    keys = ("VendorNumber", "Brand")
    strict = purchase_summary(small["purchases"], small["purchase_prices"], keys)
    assert strict.count() == 4
    assert key_violations(strict, keys).count() == 0
    loose = purchase_summary(small["purchases"], small["purchase_prices"])
    assert {(r.VendorNumber, r.Brand) for r in key_violations(loose, keys).collect()} == {(1, 1), (2, 1)}


def test_max_variant_has_one_row_per_brand(small):
    rows = purchase_summary_max(small["purchases"], small["purchase_prices"]).collect()
    found = {(r.VendorNumber, r.Brand): (float(r.ActualPrice), r.TotalPurchaseQuantity) for r in rows}
    assert found == {(1, 1): (6.0, 30), (2, 1): (6.0, 8), (2, 2): (9.0, 1), (1, 4): (2.0, 4)}


def test_summary_of_missing_sides(small):
    raw = vendor_summary(small["purchases"], small["purchase_prices"], small["sales"], small["vendor_invoice"])
    unsold = raw.where("Brand = 2").first()
    assert unsold.TotalSalesDollars is None and unsold.FreightCost is None and unsold.Volume is None
    cleaned = clean_summary(raw)
    unsold = cleaned.where("Brand = 2").first()
    assert (unsold.TotalSalesDollars, unsold.FreightCost, unsold.Volume) == (0.0, 0.0, 0)
    assert (unsold.GrossProfit, unsold.ProfitMargin, unsold.StockTurnover) == (-4.0, 0.0, 0.0)
    acme = cleaned.where("VendorNumber = 1 AND Brand = 1").collect()
    assert {r.FreightCost for r in acme} == {2.0}  # a vendor's freight stands on each row
    assert {(r.VendorName, r.Description) for r in acme} == {("Acme", "Rum")}


def test_summary_equals_literal_sql(spark, small):
    for name, df in small.items():
        df.createOrReplaceTempView(f"t_{name}")
    literal = spark.sql("""
        SELECT VendorNumber, Brand, Price, q, d,
          (SELECT sum(SalesDollars) FROM t_sales s WHERE s.VendorNo = b.VendorNumber AND s.Brand = b.Brand) AS sold,
          (SELECT sum(Freight) FROM t_vendor_invoice v WHERE v.VendorNumber = b.VendorNumber) AS freight
        FROM (SELECT VendorNumber, VendorName, Brand, Description, PurchasePrice, Price, Volume,
                sum(Quantity) AS q, sum(Dollars) AS d
              FROM t_purchases JOIN (SELECT Brand, Price, Volume FROM t_purchase_prices) USING (Brand)
              WHERE PurchasePrice > 0 GROUP BY ALL) AS b
    """)
    raw = vendor_summary(small["purchases"], small["purchase_prices"], small["sales"], small["vendor_invoice"])
    mine = raw.select("VendorNumber", "Brand", "ActualPrice", "TotalPurchaseQuantity", "TotalPurchaseDollars", "TotalSalesDollars", "FreightCost")
    as_floats = lambda df: sorted(
        (tuple(None if v is None else float(v) for v in r) for r in df.collect()), key=str
    )
    assert as_floats(mine) == as_floats(literal)


def test_order_is_by_purchase_dollars(small):
    raw = vendor_summary(
        small["purchases"], small["purchase_prices"], small["sales"], small["vendor_invoice"], ordered=True
    )
    dollars = [r.TotalPurchaseDollars for r in raw.collect()]
    assert dollars == sorted(dollars, reverse=True)


# One published run: five rows before and after cleaning.
# Published rows before and after cleaning.
BEFORE = [
    (1128, "BROWN-FORMAN CORP           ", 145080.0, 3811251.60, 142049.0, 5101919.51),
    (4425, "MARTIGNETTI COMPANIES", 164038.0, 3804041.22, 160247.0, 4819073.49),
    (17035, "PERNOD RICARD USA          ", 187407.0, 3418303.68, 187140.0, 4538120.60),
    (3960, "DIAGEO NORTH AMERICA INC", 201682.0, 3261197.94, 200412.0, 4475972.88),
    (3960, "DIAGEO NORTH AMERICA INC ", 138109.0, 3023206.01, 135838.0, 4223107.62),
]
AFTER = [
    (1290667.91, 25.297693, 0.979108, 1.338647),
    (1015032.27, 21.062810, 0.976890, 1.266830),
    (1119816.92, 24.675786, 0.998575, 1.327594),
    (1214774.94, 27.139908, 0.993703, 1.372493),
    (1199901.61, 28.412764, 0.983556, 1.396897),
]
CLEAN = "VendorNumber int, VendorName string, TotalPurchaseQuantity double, TotalPurchaseDollars double, TotalSalesQuantity double, TotalSalesDollars double"


def test_metrics_of_a_published_run(spark):
    df = add_metrics(trim_names(spark.createDataFrame(BEFORE, CLEAN), ("VendorName",)))
    for row, want in zip(df.collect(), AFTER, strict=True):
        got = (row.GrossProfit, row.ProfitMargin, row.StockTurnover, row.SalesPurchaseRatio)
        assert got == pytest.approx(want, abs=6e-7, rel=1e-9)
        assert row.VendorName == row.VendorName.strip()


def test_metric_edges(spark):
    rows = [(1, "a", 4.0, 10.0, 0.0, 0.0), (2, "b", 0.0, 0.0, 0.0, 0.0), (3, "c", 0.0, 0.0, 5.0, 7.0)]
    got = add_metrics(spark.createDataFrame(rows, CLEAN)).collect()
    assert (got[0].ProfitMargin, got[0].SalesPurchaseRatio) == (0.0, 0.0)
    assert got[1].ProfitMargin is None and got[1].StockTurnover is None
    assert (got[2].StockTurnover, got[2].SalesPurchaseRatio) == (0.0, 0.0)


def test_missing_text_stays_missing(spark):
    df = spark.createDataFrame([(None, None, float("nan"))], "t string, n int, d double")
    assert fill_numeric(df).first().asDict() == {"t": None, "n": 0, "d": 0.0}


def test_fanout_equals_the_literal_join(tables):
    prices, sales, invoices = (tables[n] for n in ("purchase_prices", "sales", "vendor_invoice"))
    twice = prices.unionByName(prices.where("Brand % 7 = 0"))  # listings repeated
    joined = twice.join(sales.withColumnRenamed("VendorNo", "VendorNumber"), ["VendorNumber", "Brand"]).join(
        invoices.select("VendorNumber", "Quantity", "Dollars", "Freight"), "VendorNumber"
    )
    literal = joined.groupBy("VendorNumber", "Brand", "Price", "PurchasePrice").agg(
        *[F.sum(c).cast("double") for c in ("SalesQuantity", "SalesDollars", "SalesPrice", "ExciseTax", "Quantity", "Dollars", "Freight")]
    )
    as_floats = lambda df: sorted(tuple(float(v) for v in r) for r in df.collect())
    mine = as_floats(fanout_summary(twice, sales, invoices))
    assert len(mine) > 100
    assert mine == as_floats(literal)


def test_whole_pipeline_counts(tables):
    summary = order_by_purchases(build_summary(tables))
    assert summary.count() == 200
    assert len(summary.columns) == 18
    assert summary.where("TotalSalesQuantity = 0").count() == 8
