"""Business questions on the profitable rows of the vendor summary.

Results are reports: the ``k`` largest or smallest groups, found with a
distributed top-k rather than a full sort. Groups drop a missing key. Totals use
exact sums, so they do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import exact_sum, float_div, format_dollars, round_half_even
from shelfwise.operators.metrics import (
    ORDER_SIZES,
    with_order_size,
    with_unit_price,
    with_unsold_value,
)
from shelfwise.operators.quantiles import quantile_columns
from shelfwise.session import materialize

SHARE, RUNNING_SHARE = "PurchaseContribution%", "CumulativeContribution%"
OTHER = "Other Vendors"


def _group(df: DataFrame, key: str):
    return df.where(F.col(key).isNotNull()).groupBy(key)


def brand_performance(rows: DataFrame) -> DataFrame:
    """Sales total and mean margin per product description."""
    return _group(rows, "Description").agg(
        exact_sum("TotalSalesDollars").alias("TotalSalesDollars"),
        F.avg("ProfitMargin").alias("ProfitMargin"),
    )


def cap_sales(brands: DataFrame, limit: float = 10_000) -> DataFrame:
    """Brands that sold for less than ``limit``."""
    return brands.where(F.col("TotalSalesDollars") < limit)


def _brand_thresholds(brands: DataFrame, low: float, high: float) -> DataFrame:
    """One row (low_sales, high_margin)."""
    measures = ["TotalSalesDollars", "ProfitMargin"]
    at = quantile_columns(brands, measures, (low, high), ("at_low", "at_high"))
    return at.agg(
        F.max(F.when(F.col("column") == "TotalSalesDollars", F.col("at_low"))).alias("low_sales"),
        F.max(F.when(F.col("column") == "ProfitMargin", F.col("at_high"))).alias("high_margin"),
    )


def _flag_targets(rows: DataFrame, low: float, high: float) -> DataFrame:
    # Written once: thresholds and flags must see the very same means.
    brands = materialize(brand_performance(rows), "brands")
    limits = _brand_thresholds(brands, low, high)
    limit = limits.select(F.struct("low_sales", "high_margin").alias("limits")).scalar()
    return brands.withColumns(
        {"LowSalesThreshold": limit["low_sales"], "HighMarginThreshold": limit["high_margin"]}
    ).withColumn(
        "IsTarget",
        (F.col("TotalSalesDollars") <= F.col("LowSalesThreshold"))
        & (F.col("ProfitMargin") >= F.col("HighMarginThreshold")),
    )


def target_brands(rows: DataFrame, low: float = 0.15, high: float = 0.85) -> DataFrame:
    """Brands with low sales and a high margin, smallest sales first."""
    return (
        _flag_targets(rows, low, high)
        .where("IsTarget")
        .select("Description", "TotalSalesDollars", "ProfitMargin")
        .orderBy("TotalSalesDollars", "Description")
    )


def brand_scatter(
    rows: DataFrame, limit: float = 10_000, low: float = 0.15, high: float = 0.85
) -> DataFrame:
    """Brands below a sales cap, flagged as target or not, with the thresholds.

    Thresholds come from all brands, before the cap.
    """
    return cap_sales(_flag_targets(rows, low, high), limit)


def _top(rows: DataFrame, key: str, k: int) -> DataFrame:
    totals = _group(rows, key).agg(exact_sum("TotalSalesDollars").alias("TotalSalesDollars"))
    return totals.orderBy(F.desc("TotalSalesDollars"), key).limit(k)


def top_vendors(rows: DataFrame, k: int = 10) -> DataFrame:
    """Vendors with the largest sales."""
    return _top(rows, "VendorName", k)


def top_brands(rows: DataFrame, k: int = 10) -> DataFrame:
    """Products with the largest sales, also as money text."""
    return _top(rows, "Description", k).withColumn("SalesText", format_dollars("TotalSalesDollars"))


def vendor_performance(rows: DataFrame, by: str = "VendorName") -> DataFrame:
    """Purchases, profit and sales per vendor."""
    return _group(rows, by).agg(
        exact_sum("TotalPurchaseDollars").alias("TotalPurchaseDollars"),
        exact_sum("GrossProfit").alias("GrossProfit"),
        exact_sum("TotalSalesDollars").alias("TotalSalesDollars"),
    )


def _shares(rows: DataFrame, by: str) -> DataFrame:
    total = rows.where(F.col(by).isNotNull()).agg(exact_sum("TotalPurchaseDollars").alias("t"))
    groups = vendor_performance(rows, by).withColumn("all_purchases", total.scalar())
    share = float_div("TotalPurchaseDollars", "all_purchases") * 100
    return groups.withColumn(SHARE, share).drop("all_purchases")


def _rounded(shares: DataFrame, by: str) -> DataFrame:
    measures = ("TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars", SHARE)
    return shares.select(by, *[round_half_even(f"`{c}`").alias(c) for c in measures])


def _by_share(by: str) -> list:
    return [F.desc(f"`{SHARE}`"), F.col(by)]


def purchase_contribution(rows: DataFrame, by: str = "VendorName") -> DataFrame:
    """Share of all purchase dollars per group, largest first, rounded to cents.

    Sorted on the exact share; ``by="Description"`` gives the brand shares.
    """
    return _rounded(_shares(rows, by).orderBy(*_by_share(by)), by)


def _leaders(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest shares with a position, rounded."""
    best = _shares(rows, "VendorName").orderBy(*_by_share("VendorName")).limit(k)
    # Only k rows reach this window.
    position = F.row_number().over(Window.orderBy(*_by_share("VendorName")))
    placed = best.withColumn("Position", position)
    return placed.select(
        "Position",
        "VendorName",
        *[
            round_half_even(f"`{c}`").alias(c)
            for c in ("TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars", SHARE)
        ],
    )


def pareto(rows: DataFrame, k: int = 10) -> DataFrame:
    """Leading vendors with money as text and the running sum of rounded shares."""
    money = ("TotalPurchaseDollars", "GrossProfit", "TotalSalesDollars")
    so_far = Window.orderBy("Position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum(f"`{SHARE}`").over(so_far)
    return _leaders(rows, k).withColumn(RUNNING_SHARE, running).select(
        "VendorName", *[format_dollars(c).alias(c) for c in money], f"`{SHARE}`", f"`{RUNNING_SHARE}`"
    )


def contribution_total(rows: DataFrame, k: int = 10) -> DataFrame:
    """Sum of the rounded shares of the leading vendors, one row."""
    total = round_half_even(f"sum(`{SHARE}`)")
    return _leaders(rows, k).agg(total.alias("TopContribution%"))


def contribution_with_other(rows: DataFrame, k: int = 10) -> DataFrame:
    """Rounded shares of the leading vendors and, as one more row, of the rest."""
    leaders = _leaders(rows, k).select("Position", "VendorName", f"`{SHARE}`")
    rest = leaders.agg(
        (F.count(F.lit(1)) + 1).cast("int").alias("Position"),
        F.lit(OTHER).alias("VendorName"),
        (100 - F.coalesce(F.sum(f"`{SHARE}`"), F.lit(0.0))).alias(SHARE),
    )
    return leaders.unionByName(rest).orderBy("Position")


def slow_vendors(rows: DataFrame, k: int = 10) -> DataFrame:
    """Vendors with the lowest mean turnover over rows that turn less than once."""
    means = _group(rows.where("StockTurnover < 1"), "VendorName").agg(
        F.avg("StockTurnover").alias("StockTurnover")
    )
    return means.orderBy("StockTurnover", "VendorName").limit(k)


def locked_capital(rows: DataFrame, k: int = 10) -> DataFrame:
    """Vendors with the most capital in unsold stock, as money text."""
    locked = _group(with_unsold_value(rows), "VendorName").agg(
        exact_sum("UnsoldInventoryValue").alias("value")
    )
    top = locked.orderBy(F.desc("value"), "VendorName").limit(k)
    return top.select("VendorName", format_dollars("value").alias("UnsoldInventoryValue"))


def total_locked_capital(rows: DataFrame) -> DataFrame:
    """All capital in unsold stock: one row with the number and its text."""
    total = with_unsold_value(rows).agg(
        exact_sum("UnsoldInventoryValue").alias("UnsoldInventoryValue")
    )
    return total.withColumn("UnsoldInventoryText", format_dollars("UnsoldInventoryValue"))


def unit_price_by_order_size(rows: DataFrame) -> DataFrame:
    """Mean unit cost per order size; a size without rows shows null."""
    sized = with_order_size(with_unit_price(rows))
    means = [
        F.avg(F.when(F.col("OrderSize") == size, F.col("UnitPurchasePrice"))).alias(size)
        for size in ORDER_SIZES
    ]
    return sized.agg(*means).unpivot([], list(ORDER_SIZES), "OrderSize", "UnitPurchasePrice")


def kpis(rows: DataFrame) -> DataFrame:
    """Sales, purchases, profit, mean margin and unsold capital, one row."""
    return with_unsold_value(rows).agg(
        exact_sum("TotalSalesDollars").alias("TotalSales"),
        exact_sum("TotalPurchaseDollars").alias("TotalPurchases"),
        exact_sum("GrossProfit").alias("GrossProfit"),
        F.avg("ProfitMargin").alias("AvgProfitMargin"),
        exact_sum("UnsoldInventoryValue").alias("UnsoldCapital"),
    )
