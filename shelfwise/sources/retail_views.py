"""The retail source tables, derived from the TPC-H-like base tables.

Four views with the columns the analytics read: ``purchases``,
``purchase_prices``, ``vendor_invoice`` and ``sales``. Keys are 64-bit so that
they hold at any scale factor. Amounts are computed in whole cents with
``floor``, which keeps them equal on every engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("purchases", "purchase_prices", "sales", "vendor_invoice")
CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


class LazyTables(dict):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self._build = build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]


def read_base(spark: SparkSession, folder: str) -> LazyTables:
    """Scans of the base tables."""
    return LazyTables(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))


def _with_suppliers(base: LazyTables, table: str) -> DataFrame:
    """A base table with the number of suppliers as the column ``suppliers``."""
    count = base["supplier"].agg(F.count(F.lit(1)).alias("n")).scalar()
    return base[table].withColumn("suppliers", count)


def _dollars(cents: str) -> str:
    return f"CAST(CAST({cents} AS BIGINT) * 0.01BD AS DECIMAL(12,2))"


def purchase_prices(base: LazyTables) -> DataFrame:
    """Price list: one row per (vendor, brand), some brands with a second vendor."""
    part = _with_suppliers(base, "part").selectExpr(
        "p_partkey AS Brand",
        "suppliers",
        "concat(p_name, ' ', p_brand) AS Description",
        f"{CENTS} * p_size AS list_price",
        "CAST(p_size * 50 AS INT) AS volume_ml",
    )
    cost = _dollars("floor(list_price * (45 + Brand % 60) / 1000)")
    main = part.selectExpr(
        "Brand % suppliers AS VendorNumber",
        "Brand",
        "Description",
        f"{_dollars('floor(list_price / 10)')} AS Price",
        f"CASE WHEN Brand % 97 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE {cost} END AS PurchasePrice",
        "CASE WHEN Brand % 41 <> 0 THEN volume_ml END AS Volume",
    )
    second = part.where("Brand % 53 = 0").selectExpr(
        "(Brand + 1) % suppliers AS VendorNumber",
        "Brand",
        "Description",
        f"{_dollars('floor(list_price / 10 + 100)')} AS Price",
        f"{_dollars('floor(list_price / 12)')} AS PurchasePrice",
        "volume_ml AS Volume",
    )
    return main.unionByName(second)


def purchases(base: LazyTables) -> DataFrame:
    """Purchase lines: the finished order lines at the cost of their main vendor."""
    lines = _with_suppliers(base, "lineitem").where("l_linestatus = 'F'").selectExpr(
        "l_partkey % suppliers AS VendorNumber",
        "l_partkey AS Brand",
        "l_orderkey AS PONumber",
        "CAST(l_quantity AS INT) AS Quantity",
    )
    names = base["supplier"].selectExpr(
        "s_suppkey AS VendorNumber", "concat(s_name, '   ') AS VendorName"
    )
    prices = purchase_prices(base).select("VendorNumber", "Brand", "Description", "PurchasePrice")
    named_prices = prices.join(names, "VendorNumber")
    return lines.join(named_prices, ["VendorNumber", "Brand"]).selectExpr(
        "VendorNumber",
        "VendorName",
        "Brand",
        "Description",
        "PONumber",
        "PurchasePrice",
        "Quantity",
        "CAST(PurchasePrice * Quantity AS DECIMAL(12,2)) AS Dollars",
    )


def sales(base: LazyTables) -> DataFrame:
    """Sale lines: the open order lines, some brands never sold."""
    sold = "l_linestatus = 'O' AND l_partkey % 23 <> 0"
    lines = _with_suppliers(base, "lineitem").where(sold).selectExpr(
        "l_partkey % suppliers AS VendorNo",
        "l_partkey AS Brand",
        "CAST(l_quantity AS INT) AS SalesQuantity",
        "CAST(round(l_discount * 100) AS INT) AS discount",
        "CAST(round(l_tax * 100) AS INT) AS tax",
    )
    part = base["part"].selectExpr("p_partkey AS Brand", f"{CENTS} * p_size AS list_price")
    price = _dollars("floor(list_price * (100 - discount) / 1000)")
    priced = lines.join(part, "Brand").selectExpr("*", f"{price} AS SalesPrice")
    return priced.selectExpr(
        "VendorNo",
        "Brand",
        "SalesQuantity",
        "SalesPrice",
        "CAST(SalesPrice * SalesQuantity AS DECIMAL(12,2)) AS SalesDollars",
        "CAST(SalesQuantity * tax AS DECIMAL(12,2)) AS ExciseTax",
    )


def vendor_invoice(base: LazyTables) -> DataFrame:
    """Freight invoices: one per order, one vendor has none."""
    cents = "round(o_totalprice * 100)"
    return _with_suppliers(base, "orders").where("o_custkey % suppliers <> 7").selectExpr(
        "o_custkey % suppliers AS VendorNumber",
        "o_orderkey AS PONumber",
        "CAST(1 + o_orderkey % 500 AS INT) AS Quantity",
        f"{_dollars(f'floor({cents})')} AS Dollars",
        f"{_dollars(f'floor({cents} / 200)')} AS Freight",
    )


def retail_tables(spark: SparkSession, folder: str) -> LazyTables:
    """The four source tables by name."""
    base = read_base(spark, folder)
    views = {
        "purchases": purchases,
        "purchase_prices": purchase_prices,
        "sales": sales,
        "vendor_invoice": vendor_invoice,
    }
    return LazyTables(lambda name: views[name](base))
