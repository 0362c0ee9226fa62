"""Aggregates of the source tables.

Every fact table is reduced on its own keys before it meets another one. Sums
combine map-side, so a vendor or brand that holds most of the rows reaches the
shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import salted_join

PURCHASE_KEYS = ("VendorNumber", "VendorName", "Brand", "Description", "PurchasePrice")


def freight_summary(invoices: DataFrame) -> DataFrame:
    """Freight paid per vendor."""
    return invoices.groupBy("VendorNumber").agg(F.sum("Freight").alias("FreightCost"))


def sales_summary(sales: DataFrame) -> DataFrame:
    """Sales totals per vendor and brand; ``TotalSalesPrice`` adds up unit prices."""
    return sales.groupBy(F.col("VendorNo").alias("VendorNumber"), "Brand").agg(
        F.sum("SalesQuantity").alias("TotalSalesQuantity"),
        F.sum("SalesDollars").alias("TotalSalesDollars"),
        F.sum("SalesPrice").alias("TotalSalesPrice"),
        F.sum("ExciseTax").alias("TotalExciseTax"),
    )


def purchase_summary(
    purchases: DataFrame, prices: DataFrame, price_keys: Sequence[str] = ("Brand",)
) -> DataFrame:
    """Purchase totals per vendor, brand, cost and offered price.

    A purchase meets every price row of its brand. Purchases shrink to their
    groups and price rows to distinct offers with a count before the join; an
    offer listed n times counts the purchase n times. After the join each row is
    already one group, so no further aggregation is needed. ``price_keys`` of
    ``("VendorNumber", "Brand")`` ties an offer to its vendor.
    """
    lines = purchases.where("PurchasePrice > 0").groupBy(*PURCHASE_KEYS).agg(
        F.sum("Quantity").alias("quantity"), F.sum("Dollars").alias("dollars")
    )
    offers = prices.groupBy(*price_keys, "Price", "Volume").agg(F.count(F.lit(1)).alias("offers"))
    return lines.join(offers, list(price_keys)).select(
        *PURCHASE_KEYS,
        F.col("Price").alias("ActualPrice"),
        "Volume",
        (F.col("quantity") * F.col("offers")).alias("TotalPurchaseQuantity"),
        (F.col("dollars") * F.col("offers")).alias("TotalPurchaseDollars"),
    )


def purchase_summary_max(
    purchases: DataFrame, prices: DataFrame, price_keys: Sequence[str] = ("Brand",)
) -> DataFrame:
    """One row per vendor and brand with the highest cost, price and volume."""
    keys = ("VendorNumber", "VendorName", "Brand")
    lines = purchases.where("PurchasePrice > 0").groupBy(*keys).agg(
        F.max("PurchasePrice").alias("PurchasePrice"),
        F.sum("Quantity").alias("quantity"),
        F.sum("Dollars").alias("dollars"),
    )
    offers = prices.groupBy(*price_keys).agg(
        F.max("Volume").alias("Volume"),
        F.max("Price").alias("ActualPrice"),
        F.count(F.lit(1)).alias("offers"),
    )
    names = ("VendorNumber", "VendorName")
    return salted_join(lines, offers, price_keys, names, "inner", salts=2).select(
        *keys,
        "PurchasePrice",
        "Volume",
        "ActualPrice",
        (F.col("quantity") * F.col("offers")).alias("TotalPurchaseQuantity"),
        (F.col("dollars") * F.col("offers")).alias("TotalPurchaseDollars"),
    )


def order_by_total_purchases(summary: DataFrame) -> DataFrame:
    """Purchase totals, largest first, ties by vendor and brand."""
    return summary.orderBy(F.desc("TotalPurchaseDollars"), "VendorNumber", "Brand")


def order_by_total_sales(summary: DataFrame) -> DataFrame:
    """Sales totals, largest first, ties by vendor and brand."""
    return summary.orderBy(F.desc("TotalSalesDollars"), "VendorNumber", "Brand")


def purchases_by_brand_price(purchases: DataFrame) -> DataFrame:
    """Quantity and dollars per brand and cost."""
    known = purchases.where("Brand IS NOT NULL AND PurchasePrice IS NOT NULL")
    return known.groupBy("Brand", "PurchasePrice").agg(
        F.sum("Quantity").alias("Quantity"), F.sum("Dollars").alias("Dollars")
    )


def sales_by_brand(sales: DataFrame) -> DataFrame:
    """Dollars, added unit prices and quantity per brand."""
    return sales.where("Brand IS NOT NULL").groupBy("Brand").agg(
        F.sum("SalesDollars").alias("SalesDollars"),
        F.sum("SalesPrice").alias("SalesPrice"),
        F.sum("SalesQuantity").alias("SalesQuantity"),
    )
