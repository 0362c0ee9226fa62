"""

The cleaned vendor summary is built once per session and input folder and
written to the shared folder, as the analytics expect it as a stored table; the
questions and statistics scan that table. If the input changes within a session,
the stored summary is stale: start a new session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import sql
from shelfwise.functions.scalars import format_dollars, round_half_even
from shelfwise.operators import aggregates, distributions, inference, metrics, profile, quantiles
from shelfwise.plans import questions, summary
from shelfwise.session import materialize, scratch_path, tune
from shelfwise.sources import csv_import, tables
from shelfwise.sources.retail_views import TABLES, LazyTables, read_base, retail_tables

try:  # the subpackage may be absent
    import corpus_pipeline
    from shelfwise.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

VENDOR = 5
SMOKE_DIR = "/root/testdata/sf0.001"
_stored: dict[tuple[str, str], DataFrame] = {}
_tables: dict[tuple[str, str], LazyTables] = {}

Query = Callable[[SparkSession, str], DataFrame]


def _sources(spark: SparkSession, folder: str) -> LazyTables:
    """The source tables of an input folder, as lazy plans."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = retail_tables(tune(spark), folder)
    return _tables[key]


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    """The stored summary table of an input folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stored:
        built = summary.build_summary(_sources(spark, folder))
        _stored[key] = materialize(built, "vendor_sales_summary")
    return _stored[key]


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round means and ratios: their last bits depend on the order of the rows."""
    if not columns:
        return df
    return df.withColumns({c: round_half_even(f"`{c}`", digits) for c in columns})


def _doubles(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles."""
    wide = [c for c, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in wide}) if wide else df


RATIOS = ("ProfitMargin", "StockTurnover", "SalesPurchaseRatio")


def _on_tables(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: _doubles(build(_sources(spark, folder)))


def _on_summary(build: Callable[[DataFrame], DataFrame], round_: Sequence[str] = ()) -> Query:
    return lambda spark, folder: _rounded(build(_summary(spark, folder)), round_)


def _on_good(
    build: Callable[[DataFrame], DataFrame], round_: Sequence[str] = (), digits: int = 6
) -> Query:
    """Query on the profitable rows."""
    return lambda spark, folder: _rounded(
        build(metrics.profitable(_summary(spark, folder))), round_, digits
    )


def _raw_summary(t: dict[str, DataFrame]) -> DataFrame:
    return summary.vendor_summary(t["purchases"], t["purchase_prices"], t["sales"], t["vendor_invoice"])


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def _csv_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Price list as CSV with untidy headers, imported again."""
    path = scratch_path(spark, "csv")
    prices = _sources(spark, folder)["purchase_prices"]
    volume = F.coalesce(F.col("Volume").cast("string"), F.lit("Unknown"))
    _write_csv(prices.withColumn("Volume", volume), f"{path}/prices.csv")
    csv_import.load_csv(spark, f"{path}/prices.csv", f"{path}/prices")
    loaded = _doubles(spark.read.parquet(f"{path}/prices"))
    kinds = {"VendorNumber": "bigint", "Brand": "bigint", "Volume": "int"}
    return loaded.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


def _csv_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices as CSV with day-first dates, flags and spaced headers, imported again."""
    path = scratch_path(spark, "csv")
    orders = read_base(spark, folder)["orders"].select(
        F.col("o_orderkey").alias(" PO Number"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("Invoice  Date "),
        F.col("o_totalprice").alias("Total Price"),
        F.when(F.col("o_custkey") % 2 == 0, "True").otherwise("False").alias("Even"),
        F.col("o_orderpriority").alias("Priority"),
    )
    _write_csv(orders, f"{path}/invoices.csv")
    csv_import.load_csv(spark, f"{path}/invoices.csv", f"{path}/invoices")
    loaded = _doubles(spark.read.parquet(f"{path}/invoices"))
    return loaded.withColumns(
        {
            "PO_Number": F.col("PO_Number").cast("bigint"),
            "Invoice_Date": F.col("Invoice_Date").cast("date").cast("string"),
        }
    )


def _csv_status(spark: SparkSession, folder: str) -> DataFrame:
    """All source tables as CSV files, imported as a set; one more is malformed, one is missing."""
    path = scratch_path(spark, "csv")
    for name in TABLES:
        _write_csv(_sources(spark, folder)[name], f"{path}/{name}.csv")
    # a comma that is not quoted gives its rows a cell more than the header
    extra = F.concat_ws(",", "VendorNumber", "Freight").alias("freight")
    unquoted = _sources(spark, folder)["vendor_invoice"].select("PONumber", extra).write.option("header", True)
    unquoted.option("quote", "\u0000").csv(f"{path}/begin_inventory.csv")
    report = csv_import.import_tables(spark, path, f"{path}/tables")
    return report.select("table", "status", "rows").fillna(0)


def _csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """Types, widths and lost cells of a file with a wide key, long texts, dates and odd cells."""
    path = scratch_path(spark, "csv")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    orders = read_base(spark, folder)["orders"].select(
        (F.col("o_orderkey") + 3_000_000_000).alias("Key"),
        F.expr("repeat(o_orderpriority, 80)").alias("Note"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Day"),
        F.when(F.col("o_custkey") % 7 == 0, "Unknown").otherwise(cents).alias("Cents"),
    )
    _write_csv(orders, f"{path}/orders.csv")
    return csv_import.column_report(spark, csv_import.load_csv(spark, f"{path}/orders.csv", f"{path}/orders"))


def _sink(spark: SparkSession, folder: str) -> DataFrame:
    """The summary written twice over the same target and read back."""
    target = scratch_path(spark, "sink")
    stored = _summary(spark, folder)
    tables.write_table(stored, target)
    tables.write_table(stored, target)
    return _rounded(tables.read_target(spark, target), RATIOS)


def _ensured(spark: SparkSession, folder: str) -> DataFrame:
    """A typed empty table, created once, then filled from the summary; a table of an earlier run is replaced."""
    target = scratch_path(spark, "ensured")
    name = "shelfwise_ensured"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    stored = _summary(spark, folder)
    tables.ensure_table(spark, name, stored.schema, target)
    empty = tables.ensure_table(spark, name, stored.schema, target)
    stored.select(empty.columns).write.insertInto(name)
    return _rounded(tables.scan_table(spark, name), RATIOS)


def _schema_profile(t: dict[str, DataFrame]) -> DataFrame:
    raw = _raw_summary(t)
    return profile.describe_schema(raw).join(profile.null_counts(raw), "column")


def _catalog_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The source tables as catalog views: listed, then counted."""
    prefix = "retail_"
    for name in TABLES:
        _sources(spark, folder)[name].createOrReplaceTempView(prefix + name)
    listed = tables.list_tables(spark).where(F.col("table").startswith(prefix))
    counts = profile.catalog_counts(spark, [row["table"] for row in listed.collect()])
    return counts.withColumn("table", F.regexp_replace("table", f"^{prefix}", ""))


def _key_audit(spark: SparkSession, folder: str) -> DataFrame:
    t = _sources(spark, folder)
    strict = summary.build_summary(t, ("VendorNumber", "Brand"))
    checks = {
        "prices": (t["purchase_prices"], ["VendorNumber", "Brand"]),
        "invoices": (t["vendor_invoice"], ["VendorNumber", "PONumber"]),
        "summary": (_summary(spark, folder), ["VendorNumber", "Brand"]),
        "strict summary": (strict, ["VendorNumber", "Brand"]),
    }
    found = {name: profile.key_violations(df, keys) for name, (df, keys) in checks.items()}
    return profile.table_counts(found).withColumnsRenamed({"table": "check", "rows": "violations"})


def _order_size(rows: DataFrame) -> DataFrame:
    sized = metrics.with_order_size(metrics.with_unsold_value(metrics.with_unit_price(rows)))
    return sized.select(
        "VendorNumber", "Brand", "PurchasePrice", "ActualPrice", "Volume", "TotalPurchaseQuantity",
        "UnitPurchasePrice", "UnsoldInventoryValue", "OrderSizeRank", "OrderSize",
    )


def _money_text(rows: DataFrame) -> DataFrame:
    texts: list[Column] = [
        format_dollars("GrossProfit").alias("ProfitText"),
        format_dollars("TotalSalesDollars").alias("SalesText"),
    ]
    return rows.select("VendorNumber", "Brand", "ActualPrice", "Volume", *texts)


def _margins(rows: DataFrame) -> DataFrame:
    """Margins of the top and of the low sellers."""
    return inference.cohorts(rows).withColumnRenamed("value", "ProfitMargin")


def _unit_price_box(rows: DataFrame) -> DataFrame:
    sized = metrics.with_order_size(metrics.with_unit_price(rows))
    return distributions.box_stats(sized, ["UnitPurchasePrice"], ["OrderSize"])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the cleaned vendor summary, largest purchases first."""
    built = summary.build_summary(retail_tables(tune(spark), SMOKE_DIR))
    return summary.order_by_purchases(built)


def queries() -> dict[str, Query]:
    """All queries by name; each takes the session and an input folder."""
    numeric = profile.numeric_columns
    stats = ("mean", "std", "min", "q25", "q50", "q75", "max")
    box = ("q1", "median", "q3", "whisker_low", "whisker_high")
    interval = ("mean", "lower", "upper")
    welch = ("mean_a", "mean_b", "t", "df", "p")
    share, running = questions.SHARE, questions.RUNNING_SHARE
    found: dict[str, Query] = {}

    # sources and sinks
    for name in TABLES:
        key = "VendorNo" if name == "sales" else "VendorNumber"
        found[f"scan_{name}"] = _on_tables(lambda t, n=name: t[n])
        found[f"vendor_rows_{name}"] = _on_tables(
            lambda t, n=name, k=key: tables.key_rows(t[n], VENDOR, k)
        )
    found |= {
        "csv_import_prices": _csv_prices,
        "csv_import_invoices": _csv_invoices,
        "csv_import_status": _csv_status,
        "csv_column_report": _csv_report,
        "summary_sink": _sink,
        "ensure_table": _ensured,
    }

    # profiling
    found |= {
        "table_counts": _on_tables(lambda t: profile.table_counts({n: t[n] for n in TABLES})),
        "catalog_counts": _catalog_counts,
        "schema_profile": _on_tables(_schema_profile),
        "distinct_vendor_names": _on_tables(
            lambda t: profile.distinct_values(_raw_summary(t), "VendorName")
        ),
        "distinct_descriptions": _on_tables(
            lambda t: profile.distinct_values(_raw_summary(t), "Description")
        ),
        "po_count": _on_tables(lambda t: profile.n_distinct(t["vendor_invoice"], "PONumber")),
        "describe_summary": _on_summary(profile.describe, stats),
        "key_audit": _key_audit,
        "summary_key_violations": _on_summary(
            lambda s: profile.key_violations(s, ["VendorNumber", "Brand"])
        ),
        "vendor_row_counts": _on_good(lambda p: profile.value_counts(p, "VendorName")),
        "description_row_counts": _on_good(lambda p: profile.value_counts(p, "Description")),
    }

    # aggregates and joins
    strict = ("VendorNumber", "Brand")
    found |= {
        "freight_summary": _on_tables(lambda t: aggregates.freight_summary(t["vendor_invoice"])),
        "purchase_summary": _on_tables(
            lambda t: aggregates.purchase_summary(t["purchases"], t["purchase_prices"])
        ),
        "purchase_summary_strict": _on_tables(
            lambda t: aggregates.purchase_summary(t["purchases"], t["purchase_prices"], strict)
        ),
        "purchase_summary_max": _on_tables(
            lambda t: aggregates.purchase_summary_max(t["purchases"], t["purchase_prices"])
        ),
        "purchase_summary_max_ordered": _on_tables(
            lambda t: aggregates.order_by_total_purchases(
                aggregates.purchase_summary_max(t["purchases"], t["purchase_prices"])
            )
        ),
        "sales_summary": _on_tables(lambda t: aggregates.sales_summary(t["sales"])),
        "sales_summary_ordered": _on_tables(
            lambda t: aggregates.order_by_total_sales(aggregates.sales_summary(t["sales"]))
        ),
        "purchases_by_brand_price": _on_tables(
            lambda t: aggregates.purchases_by_brand_price(t["purchases"])
        ),
        "sales_by_brand": _on_tables(lambda t: aggregates.sales_by_brand(t["sales"])),
        "fanout_summary": _on_tables(
            lambda t: summary.fanout_summary(t["purchase_prices"], t["sales"], t["vendor_invoice"])
        ),
        "vendor_summary": _on_tables(_raw_summary),
        "clean_summary": _on_tables(lambda t: _rounded(summary.build_summary(t), RATIOS)),
        "strict_summary": _on_tables(lambda t: _rounded(summary.build_summary(t, strict), RATIOS)),
        "summary_head": _on_summary(lambda s: tables.head(s, summary.purchase_order()), RATIOS),
    }

    # questions
    million = 1_000_000
    found |= {
        "profitable_rows": _on_good(lambda p: p, RATIOS),
        "kpis": _on_good(questions.kpis, ["AvgProfitMargin"]),
        "brand_performance": _on_good(questions.brand_performance, ["ProfitMargin"]),
        "capped_brands": _on_good(
            lambda p: questions.cap_sales(questions.brand_performance(p), million), ["ProfitMargin"]
        ),
        "target_brands": _on_good(questions.target_brands, ["ProfitMargin"]),
        "brand_scatter": _on_good(
            lambda p: questions.brand_scatter(p, million),
            ["ProfitMargin", "LowSalesThreshold", "HighMarginThreshold"],
        ),
        "top_vendors": _on_good(questions.top_vendors),
        "top_brands": _on_good(questions.top_brands),
        "vendor_performance": _on_good(questions.vendor_performance),
        "vendor_contribution": _on_good(questions.purchase_contribution),
        "brand_contribution": _on_good(lambda p: questions.purchase_contribution(p, "Description")),
        "pareto": _on_good(questions.pareto, [running], 2),
        "top_contribution": _on_good(questions.contribution_total),
        "contribution_with_other": _on_good(questions.contribution_with_other, [share], 2),
        "slow_vendors": _on_good(questions.slow_vendors, ["StockTurnover"]),
        "locked_capital": _on_good(questions.locked_capital),
        "total_locked_capital": _on_good(questions.total_locked_capital),
        "order_size": _on_good(_order_size, ["UnitPurchasePrice", "UnsoldInventoryValue"]),
        "unit_price_by_order_size": _on_good(
            questions.unit_price_by_order_size, ["UnitPurchasePrice"]
        ),
        "money_text": _on_summary(_money_text),
    }

    # statistics
    found |= {
        "quantiles": _on_good(
            lambda p: quantiles.quantiles(p, numeric(p), (0.15, 0.25, 0.75, 0.85)), ["quantile"]
        ),
        "histogram_summary": _on_summary(
            lambda s: distributions.histogram(s, numeric(s)), ["left", "right"]
        ),
        "histogram_profitable": _on_good(
            lambda p: distributions.histogram(p, numeric(p)), ["left", "right"]
        ),
        "density_summary": _on_summary(lambda s: distributions.kde(s, numeric(s)), ["x", "y"]),
        "density_curves": _on_good(lambda p: distributions.kde(p, numeric(p)), ["x", "y"]),
        "histogram_cohorts": _on_good(
            lambda p: distributions.histogram(_margins(p), ["ProfitMargin"], by=["cohort"]), ["left", "right"]
        ),
        "density_cohorts": _on_good(
            lambda p: distributions.kde(_margins(p), ["ProfitMargin"], by=["cohort"]), ["x", "y"]
        ),
        "box_summary": _on_summary(lambda s: distributions.box_stats(s, numeric(s)), box),
        "box_unit_price": _on_good(_unit_price_box, box),
        "correlation_matrix": _on_good(lambda p: inference.correlation_matrix(p, numeric(p)), ["r"]),
        "margin_ci": _on_good(lambda p: inference.mean_ci(p, "ProfitMargin"), interval),
        "margin_ci_top_low": _on_good(inference.ci_top_low, interval),
        "margin_ci_top_low_strict": _on_good(
            lambda p: inference.ci_top_low(p, low_rule="le"), interval
        ),
        "welch_test": _on_good(inference.welch_test, welch),
    }
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL twin of each query for DuckDB on the same tables."""
    found = sql.build()
    if llm_queries:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
