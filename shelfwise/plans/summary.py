"""The vendor summary: source tables to one row per vendor, brand and price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.aggregates import freight_summary, purchase_summary, sales_summary
from shelfwise.operators.joins import hot_keys, salted_join
from shelfwise.operators.metrics import add_metrics, fill_numeric, trim_names

AMOUNTS = (
    "TotalPurchaseQuantity",
    "TotalPurchaseDollars",
    "TotalSalesQuantity",
    "TotalSalesDollars",
    "TotalSalesPrice",
    "TotalExciseTax",
    "FreightCost",
)


def vendor_summary(
    purchases: DataFrame,
    prices: DataFrame,
    sales: DataFrame,
    invoices: DataFrame,
    price_keys: Sequence[str] = ("Brand",),
    ordered: bool = False,
) -> DataFrame:
    """Purchases, sales and freight side by side.

    Each fact table is aggregated before the joins. Sums run on exact types and
    become doubles at the end. A vendor's freight stands on each of its rows, so
    it must not be added up over brands. ``ordered`` sorts the whole result by
    purchase dollars; leave it off when the result is written or filtered.
    """
    bought = purchase_summary(purchases, prices, price_keys)
    detail = ("VendorName", "Description", "PurchasePrice", "ActualPrice", "Volume")
    # One vendor may own a third of all rows, and so may one of its brands.
    brands, vendors = hot_keys(purchases, ["VendorNumber", "Brand"], ["VendorNumber"])
    sold = salted_join(bought, sales_summary(sales), ["VendorNumber", "Brand"], detail, hot=brands)
    full = salted_join(sold, freight_summary(invoices), "VendorNumber", ("Brand", *detail), hot=vendors)
    result = full.select(
        "VendorNumber",
        "VendorName",
        "Brand",
        "Description",
        F.col("PurchasePrice").cast("double").alias("PurchasePrice"),
        F.col("ActualPrice").cast("double").alias("ActualPrice"),
        "Volume",
        *[F.col(c).cast("double").alias(c) for c in AMOUNTS],
    )
    return order_by_purchases(result) if ordered else result


def order_by_purchases(summary: DataFrame) -> DataFrame:
    """Largest purchases first, ties in key order."""
    return summary.orderBy(*purchase_order())


def purchase_order() -> list:
    """Sort columns of the summary: purchase dollars, then the keys."""
    return [
        F.desc("TotalPurchaseDollars"),
        "VendorNumber",
        "Brand",
        "PurchasePrice",
        "ActualPrice",
        F.asc_nulls_first("Volume"),
    ]


def clean_summary(summary: DataFrame) -> DataFrame:
    """Fill missing numbers, strip names, add the metrics."""
    return add_metrics(trim_names(fill_numeric(summary)))


def build_summary(tables: dict[str, DataFrame], price_keys: Sequence[str] = ("Brand",)) -> DataFrame:
    """The cleaned summary of the source tables, as one lazy plan."""
    return clean_summary(
        vendor_summary(
            tables["purchases"],
            tables["purchase_prices"],
            tables["sales"],
            tables["vendor_invoice"],
            price_keys,
        )
    )


def fanout_summary(prices: DataFrame, sales: DataFrame, invoices: DataFrame) -> DataFrame:
    """Totals of price list x sales x invoices, where each sale meets every
    invoice of its vendor.

    The many-to-many rows are never built: each table is reduced to sums and a
    row count per join key, and a sum over the join is the table's own sum times
    the row counts of the other two.
    """
    vendor_brand = ["VendorNumber", "Brand"]
    listed = prices.groupBy(*vendor_brand, "Price", "PurchasePrice").agg(
        F.count(F.lit(1)).alias("listings")
    )
    sold = sales.groupBy(F.col("VendorNo").alias("VendorNumber"), "Brand").agg(
        F.sum("SalesQuantity").alias("quantity"),
        F.sum("SalesDollars").alias("dollars"),
        F.sum("SalesPrice").alias("unit_prices"),
        F.sum("ExciseTax").alias("tax"),
        F.count(F.lit(1)).alias("sales"),
    )
    billed = invoices.groupBy("VendorNumber").agg(
        F.sum("Quantity").alias("billed_quantity"),
        F.sum("Dollars").alias("billed_dollars"),
        F.sum("Freight").alias("freight"),
        F.count(F.lit(1)).alias("invoices"),
    )
    offer = ("Price", "PurchasePrice")
    traded = salted_join(listed, sold, vendor_brand, offer, "inner", salts=2)
    joined = salted_join(traded, billed, "VendorNumber", ("Brand", *offer), "inner")

    def times(total: str, other: str):
        # Wide decimals: the products outgrow 64 bits long before the sums do.
        rows = F.col(other).cast("decimal(18,0)") * F.col("listings").cast("decimal(9,0)")
        return (F.col(total).cast("decimal(38,4)") * rows).cast("double")

    return joined.select(
        *vendor_brand,
        F.col("Price").cast("double").alias("ActualPrice"),
        F.col("PurchasePrice").cast("double").alias("PurchasePrice"),
        times("quantity", "invoices").alias("TotalSalesQuantity"),
        times("dollars", "invoices").alias("TotalSalesDollars"),
        times("unit_prices", "invoices").alias("TotalSalesPrice"),
        times("tax", "invoices").alias("TotalExciseTax"),
        times("billed_quantity", "sales").alias("TotalPurchaseQuantity"),
        times("billed_dollars", "sales").alias("TotalPurchaseDollars"),
        times("freight", "sales").alias("TotalFreightCost"),
    )
