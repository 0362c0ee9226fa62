"""Cleaning and derived columns of the vendor summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalars import float_div, safe_div, strip_ws
from shelfwise.operators.quantiles import quantile_columns

ORDER_SIZES = ("Small", "Medium", "Large")


def fill_numeric(df: DataFrame) -> DataFrame:
    """Missing numbers become 0; missing text stays missing."""
    return df.fillna(0)


def trim_names(df: DataFrame, columns: tuple[str, ...] = ("VendorName", "Description")) -> DataFrame:
    """Strip white space around the name columns."""
    return df.withColumns({c: strip_ws(c) for c in columns})


def add_metrics(df: DataFrame) -> DataFrame:
    """Gross profit, margin in percent, stock turnover and sales/purchase ratio."""
    profit = F.col("TotalSalesDollars") - F.col("TotalPurchaseDollars")
    return df.withColumn("GrossProfit", profit).withColumns(
        {
            "ProfitMargin": safe_div("GrossProfit", "TotalSalesDollars") * 100,
            "StockTurnover": safe_div("TotalSalesQuantity", "TotalPurchaseQuantity"),
            "SalesPurchaseRatio": safe_div("TotalSalesDollars", "TotalPurchaseDollars"),
        }
    )


def profitable(summary: DataFrame) -> DataFrame:
    """Rows with a profit, a positive margin and sales; a missing margin fails."""
    return summary.where("GrossProfit > 0 AND ProfitMargin > 0 AND TotalSalesQuantity > 0")


def with_unit_price(df: DataFrame) -> DataFrame:
    """Cost per bought unit."""
    return df.withColumn(
        "UnitPurchasePrice", float_div("TotalPurchaseDollars", "TotalPurchaseQuantity")
    )


def with_unsold_value(df: DataFrame) -> DataFrame:
    """Capital in stock: bought minus sold quantity, at cost. Negative if oversold."""
    unsold = F.col("TotalPurchaseQuantity") - F.col("TotalSalesQuantity")
    return df.withColumn("UnsoldInventoryValue", unsold * F.col("PurchasePrice"))


def with_order_size(df: DataFrame, column: str = "TotalPurchaseQuantity") -> DataFrame:
    """Tercile of the bought quantity as ``OrderSize`` and its ordinal.

    Bins are closed on the right, so equal quantities share a bin. Edges that
    coincide leave an empty bin and raise an error.
    """
    edges = quantile_columns(df, [column], (0.0, 1 / 3, 2 / 3, 1.0), ("e0", "e1", "e2", "e3"))
    distinct = (F.col("e0") < F.col("e1")) & (F.col("e1") < F.col("e2")) & (F.col("e2") < F.col("e3"))
    message = F.lit(f"order-size edges of {column} are not distinct")
    checked = edges.select(
        F.when(distinct, F.struct("e1", "e2")).otherwise(F.raise_error(message)).alias("edges")
    ).scalar()
    value = F.col(column)
    size = (
        F.when(value <= checked["e1"], 1).when(value <= checked["e2"], 2).when(value.isNotNull(), 3)
    )
    labels = F.array(*[F.lit(s) for s in ORDER_SIZES])
    return df.withColumn("OrderSizeRank", size).withColumn(
        "OrderSize", F.get(labels, F.col("OrderSizeRank") - 1)
    )
