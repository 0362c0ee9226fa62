"""The SQL twin of every registered query, written the literal way.

Joins are joined first and grouped after, with no pre-aggregation, so the SQL
checks the rewritten Spark plans. Rounding uses scale, round to even, scale back
on both sides.
"""

from __future__ import annotations

MONEY = "CAST({} * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"


def _money(cents: str) -> str:
    return MONEY.format(f"CAST({cents} AS BIGINT)")


def _r(expr: str, digits: int = 6) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"round_even(({expr}) * {scale}, 0) / {scale}"


CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"
N = "(SELECT count(*) FROM supplier)"

PRICES = f"""
purchase_prices AS (
  SELECT p_partkey % {N} AS VendorNumber, p_partkey AS Brand,
         concat(p_name, ' ', p_brand) AS Description,
         {_money(f"floor({CENTS} * p_size / 10)")} AS Price,
         CASE WHEN p_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(12,2))
              ELSE {_money(f"floor({CENTS} * p_size * (45 + p_partkey % 60) / 1000)")} END AS PurchasePrice,
         CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE CAST(p_size * 50 AS INT) END AS Volume
  FROM part
  UNION ALL
  SELECT (p_partkey + 1) % {N}, p_partkey, concat(p_name, ' ', p_brand),
         {_money(f"floor({CENTS} * p_size / 10 + 100)")},
         {_money(f"floor({CENTS} * p_size / 12)")},
         CAST(p_size * 50 AS INT)
  FROM part WHERE p_partkey % 53 = 0)"""

PURCHASES = f"""
purchases AS (
  SELECT pp.VendorNumber, concat(s.s_name, '   ') AS VendorName, pp.Brand, pp.Description,
         l.l_orderkey AS PONumber, pp.PurchasePrice, CAST(l.l_quantity AS INT) AS Quantity,
         CAST(pp.PurchasePrice * CAST(l.l_quantity AS INT) AS DECIMAL(12,2)) AS Dollars
  FROM lineitem l
  JOIN purchase_prices pp ON l.l_partkey = pp.Brand AND pp.VendorNumber = l.l_partkey % {N}
  JOIN supplier s ON s.s_suppkey = pp.VendorNumber
  WHERE l.l_linestatus = 'F')"""

_SALE = _money(
    f"floor({CENTS} * p_size * (100 - CAST(round(l_discount * 100) AS INT)) / 1000)"
)
SALES = f"""
sales AS (
  SELECT VendorNo, Brand, SalesQuantity, SalesPrice,
         CAST(SalesPrice * SalesQuantity AS DECIMAL(12,2)) AS SalesDollars, ExciseTax
  FROM (SELECT p_partkey % {N} AS VendorNo, p_partkey AS Brand,
               CAST(l_quantity AS INT) AS SalesQuantity, {_SALE} AS SalesPrice,
               CAST(CAST(l_quantity AS INT) * CAST(round(l_tax * 100) AS INT) AS DECIMAL(12,2)) AS ExciseTax
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_linestatus = 'O' AND l_partkey % 23 <> 0) t)"""

INVOICES = f"""
vendor_invoice AS (
  SELECT o_custkey % {N} AS VendorNumber, o_orderkey AS PONumber,
         CAST(1 + o_orderkey % 500 AS INT) AS Quantity,
         {_money("floor(round(o_totalprice * 100))")} AS Dollars,
         {_money("floor(round(o_totalprice * 100) / 200)")} AS Freight
  FROM orders WHERE o_custkey % {N} <> 7)"""


def _ratio(num: str, den: str) -> str:
    """x/0 is 0 and 0/0 is missing."""
    return f"CASE WHEN {den} <> 0 THEN {num} / {den} WHEN {num} <> 0 THEN 0.0 END"


# The price rows a purchase meets: those of its brand, or of its vendor and brand.
OFFERS = "(SELECT Brand, Price, Volume FROM purchase_prices) USING (Brand)"
STRICT_OFFERS = "(SELECT VendorNumber, Brand, Price, Volume FROM purchase_prices) USING (VendorNumber, Brand)"


def _summary(prefix: str, offers: str) -> str:
    """Raw and cleaned summary as CTEs ``<prefix>raw`` and ``<prefix>summary``.

    Sales and freight are looked up per row, so nothing is aggregated ahead.
    """
    dbl = ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}"
        for c in (
            "PurchasePrice", "ActualPrice", "TotalPurchaseQuantity", "TotalPurchaseDollars",
            "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax",
            "FreightCost",
        )
    )
    sold = "FROM sales s WHERE s.VendorNo = bought.VendorNumber AND s.Brand = bought.Brand"
    return f"""
{prefix}bought AS (
  SELECT VendorNumber, VendorName, Brand, Description, Volume, PurchasePrice, Price AS ActualPrice,
         SUM(Quantity) AS TotalPurchaseQuantity, SUM(Dollars) AS TotalPurchaseDollars
  FROM purchases JOIN {offers}
  WHERE PurchasePrice > 0 GROUP BY ALL),
{prefix}raw AS (
  SELECT VendorNumber, VendorName, Brand, Description, Volume, {dbl}
  FROM (SELECT *, (SELECT SUM(SalesQuantity) {sold}) AS TotalSalesQuantity,
               (SELECT SUM(SalesDollars) {sold}) AS TotalSalesDollars,
               (SELECT SUM(SalesPrice) {sold}) AS TotalSalesPrice,
               (SELECT SUM(ExciseTax) {sold}) AS TotalExciseTax,
               (SELECT SUM(Freight) FROM vendor_invoice v WHERE v.VendorNumber = bought.VendorNumber) AS FreightCost
        FROM {prefix}bought AS bought) AS looked_up),
{prefix}filled AS (
  SELECT * REPLACE (trim(VendorName) AS VendorName, trim(Description) AS Description,
    coalesce(Volume, 0) AS Volume, coalesce(TotalSalesQuantity, 0) AS TotalSalesQuantity,
    coalesce(TotalSalesDollars, 0) AS TotalSalesDollars, coalesce(TotalSalesPrice, 0) AS TotalSalesPrice,
    coalesce(TotalExciseTax, 0) AS TotalExciseTax, coalesce(FreightCost, 0) AS FreightCost)
  FROM {prefix}raw),
{prefix}summary AS (
  SELECT *, {_ratio("GrossProfit", "TotalSalesDollars")} * 100 AS ProfitMargin,
    {_ratio("TotalSalesQuantity", "TotalPurchaseQuantity")} AS StockTurnover,
    {_ratio("TotalSalesDollars", "TotalPurchaseDollars")} AS SalesPurchaseRatio
  FROM (SELECT *, TotalSalesDollars - TotalPurchaseDollars AS GrossProfit FROM {prefix}filled) t)"""


SUMMARY = _summary("", OFFERS)
STRICT = _summary("strict_", STRICT_OFFERS)
GOOD = """
good AS (SELECT * FROM summary WHERE GrossProfit > 0 AND ProfitMargin > 0 AND TotalSalesQuantity > 0)"""
BRANDS = """
brands AS (SELECT Description, CAST(SUM(CAST(TotalSalesDollars AS DECIMAL(28,4))) AS DOUBLE) AS TotalSalesDollars,
           AVG(ProfitMargin) AS ProfitMargin FROM good GROUP BY Description),
limits AS (SELECT quantile_cont(TotalSalesDollars, 0.15) AS low, quantile_cont(ProfitMargin, 0.85) AS high FROM brands)"""


def _sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(28,4))) AS DOUBLE)"


UNSOLD = "(TotalPurchaseQuantity - TotalSalesQuantity) * PurchasePrice"


def _text(v: str) -> str:
    return (
        f"CASE WHEN {v} >= 1000000 THEN printf('%.2fM', {v} / 1000000) "
        f"WHEN {v} >= 1000 THEN printf('%.2fK', {v} / 1000) ELSE CAST({v} AS VARCHAR) END"
    )


_SHARES = f"""
shares AS (
  SELECT {{by}}, {_sum("TotalPurchaseDollars")} AS bought, {_sum("GrossProfit")} AS profit,
         {_sum("TotalSalesDollars")} AS sold,
         {_sum("TotalPurchaseDollars")} / (SELECT {_sum("TotalPurchaseDollars")} FROM good) * 100 AS share
  FROM good GROUP BY {{by}})"""
LEADERS = f"""
leaders AS (
  SELECT row_number() OVER (ORDER BY share DESC, VendorName) AS pos, VendorName,
         {_r("bought", 2)} AS bought, {_r("profit", 2)} AS profit, {_r("sold", 2)} AS sold,
         {_r("share", 2)} AS share
  FROM shares ORDER BY share DESC, VendorName LIMIT 10)"""

NUMERIC = (
    "VendorNumber", "Brand", "PurchasePrice", "ActualPrice", "Volume", "TotalPurchaseQuantity",
    "TotalPurchaseDollars", "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice",
    "TotalExciseTax", "FreightCost", "GrossProfit", "ProfitMargin", "StockTurnover",
    "SalesPurchaseRatio",
)
TEXT = ("VendorName", "Description")

# Column types of the cleaned summary in order.
SUMMARY_TYPES = (
    ("VendorNumber", "bigint"), ("VendorName", "string"), ("Brand", "bigint"),
    ("Description", "string"), ("PurchasePrice", "double"), ("ActualPrice", "double"),
    ("Volume", "int"), ("TotalPurchaseQuantity", "double"), ("TotalPurchaseDollars", "double"),
    ("TotalSalesQuantity", "double"), ("TotalSalesDollars", "double"),
    ("TotalSalesPrice", "double"), ("TotalExciseTax", "double"), ("FreightCost", "double"),
    ("GrossProfit", "double"), ("ProfitMargin", "double"), ("StockTurnover", "double"),
    ("SalesPurchaseRatio", "double"),
)


def _long(source: str, extra: str = "") -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    return (
        f'long AS (UNPIVOT (SELECT {extra}{cols} FROM {source}) ON {", ".join(NUMERIC)} '
        'INTO NAME "column" VALUE value)'
    )


SIZED = """
edges AS (SELECT quantile_cont(TotalPurchaseQuantity, 1.0/3) AS e1, quantile_cont(TotalPurchaseQuantity, 2.0/3) AS e2 FROM good),
sized AS (
  SELECT good.*, CASE WHEN TotalPurchaseQuantity <= e1 THEN 1 WHEN TotalPurchaseQuantity <= e2 THEN 2 ELSE 3 END AS rank
  FROM good, edges)"""
SIZE_NAME = "CASE rank WHEN 1 THEN 'Small' WHEN 2 THEN 'Medium' ELSE 'Large' END"

_EDGE = "CASE WHEN {i} = 30 THEN hi ELSE lo + {i} * ((hi - lo) / 30) END"


def _edge(i: str) -> str:
    return _EDGE.format(i=i)


def _histogram(keys: str = '"column"') -> tuple[str, str]:
    """The query, and the tables it reads, of a histogram of ``long`` by keys."""
    tables = f"""
bounds AS (SELECT {keys}, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
           CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi
           FROM long GROUP BY {keys}),
guessed AS (SELECT {keys}, value, lo, hi, least(CAST(floor((value - lo) / (hi - lo) * 30) AS BIGINT), 29) AS g
            FROM long JOIN bounds USING ({keys})),
binned AS (SELECT {keys}, g + CASE WHEN value < {_edge("g")} THEN -1
             WHEN g < 29 AND value >= {_edge("(g + 1)")} THEN 1 ELSE 0 END AS i FROM guessed),
counted AS (SELECT {keys}, i, count(*) AS c FROM binned GROUP BY ALL),
slots AS (SELECT {keys}, lo, hi, i FROM bounds, generate_series(0, 29) AS g(i))"""
    query = f"""
SELECT {keys}, CAST(i + 1 AS INT) AS bin, {_r(_edge("i"))} AS "left", {_r(_edge("(i + 1)"))} AS "right",
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM slots LEFT JOIN counted USING ({keys}, i)"""
    return query, tables


def _density(keys: str = '"column"') -> tuple[str, str]:
    """The query, and the table it reads, of the density curves of ``long`` by keys."""
    query = f"""SELECT {keys}, CAST(i AS INT) AS point, {_r("any_value(x)")} AS x,
  {_r("sum(exp(-pow((x - value) / h, 2) / 2)) / (any_value(h) * sqrt(2 * pi())) * any_value((hi - lo) / 30)")} AS y
FROM (SELECT {keys}, value, h, lo, hi, i, lo + i * ((hi - lo) / 199) AS x
      FROM long JOIN shape USING ({keys}), generate_series(0, 199) AS g(i)) GROUP BY {keys}, i"""
    table = f"""shape AS (SELECT {keys}, min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS h
                     FROM long GROUP BY {keys} HAVING count(*) > 1 AND max(value) > min(value))"""
    return query, table

# Cornish-Fisher expansion of the 97.5 % t quantile around the normal one.
Z = 1.959963984540054
_G = (
    (Z**3 + Z) / 4,
    (5 * Z**5 + 16 * Z**3 + 3 * Z) / 96,
    (3 * Z**7 + 19 * Z**5 + 17 * Z**3 - 15 * Z) / 384,
    (79 * Z**9 + 776 * Z**7 + 1482 * Z**5 - 1920 * Z**3 - 945 * Z) / 92160,
)


def _t975(df: str) -> str:
    terms = " + ".join(f"{g!r}::DOUBLE / pow({df}, {k})" for k, g in enumerate(_G, start=1))
    return f"({Z!r}::DOUBLE + {terms})"


COHORT_EDGES = """
q AS (SELECT quantile_cont(TotalSalesDollars, 0.75) AS high, quantile_cont(TotalSalesDollars, 0.25) AS low FROM good)"""

COHORT_LONG = """
long AS (SELECT 'top' AS cohort, 'ProfitMargin' AS "column", ProfitMargin AS value FROM good, q WHERE TotalSalesDollars >= high
         UNION ALL SELECT 'low', 'ProfitMargin', ProfitMargin FROM good, q WHERE TotalSalesDollars >= low)"""


def _ci(low_rule: str) -> str:
    margin = f"{_t975('(n - 1)')} * sd / sqrt(n)"
    return f"""
, cohorts AS (
  SELECT 'top' AS cohort, ProfitMargin AS v FROM good, q WHERE TotalSalesDollars >= high
  UNION ALL SELECT 'low', ProfitMargin FROM good, q WHERE TotalSalesDollars {low_rule} low),
m AS (SELECT cohort, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS sd FROM cohorts GROUP BY cohort)
SELECT cohort, n, {_r("mean")} AS mean, {_r(f"mean - {margin}")} AS lower, {_r(f"mean + {margin}")} AS upper FROM m"""


WELCH = f"""
, a AS (SELECT count(ProfitMargin) AS n, avg(ProfitMargin) AS m, var_samp(ProfitMargin) AS v FROM good, q WHERE TotalSalesDollars >= high),
b AS (SELECT count(ProfitMargin) AS n, avg(ProfitMargin) AS m, var_samp(ProfitMargin) AS v FROM good, q WHERE TotalSalesDollars <= low),
w AS (SELECT a.n AS n_a, a.m AS mean_a, b.n AS n_b, b.m AS mean_b,
        (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t,
        pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)) AS df FROM a, b),
area AS (SELECT sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
           * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
           * pow(1 + pow(t * i / 4000, 2) / df, -(df + 1) / 2)) * any_value(abs(t)) / 4000 / 3 AS half
         FROM w, generate_series(0, 4000) AS g(i))
SELECT n_a, {_r("mean_a")} AS mean_a, n_b, {_r("mean_b")} AS mean_b, {_r("t")} AS t, {_r("df")} AS df,
       abs({_r("1 - 2 * half")}) AS p, 1 - 2 * half < 0.05 AS reject FROM w, area"""

SOURCE_COLUMNS = {
    "purchases": (
        "VendorNumber, VendorName, Brand, Description, PONumber, "
        "CAST(PurchasePrice AS DOUBLE) AS PurchasePrice, Quantity, CAST(Dollars AS DOUBLE) AS Dollars"
    ),
    "purchase_prices": (
        "VendorNumber, Brand, Description, CAST(Price AS DOUBLE) AS Price, "
        "CAST(PurchasePrice AS DOUBLE) AS PurchasePrice, Volume"
    ),
    "sales": (
        "VendorNo, Brand, SalesQuantity, CAST(SalesPrice AS DOUBLE) AS SalesPrice, "
        "CAST(SalesDollars AS DOUBLE) AS SalesDollars, CAST(ExciseTax AS DOUBLE) AS ExciseTax"
    ),
    "vendor_invoice": (
        "VendorNumber, PONumber, Quantity, CAST(Dollars AS DOUBLE) AS Dollars, "
        "CAST(Freight AS DOUBLE) AS Freight"
    ),
}


def _box(keys: str) -> str:
    return f"""
, qs AS (SELECT {keys}, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
         FROM long GROUP BY {keys}),
t AS (SELECT long.*, q1, median, q3, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
      FROM long JOIN qs USING ({keys}))
SELECT {keys}, count(*) AS n, {_r("any_value(q1)")} AS q1, {_r("any_value(median)")} AS median, {_r("any_value(q3)")} AS q3,
  {_r("least(min(value) FILTER (inside), any_value(q1))")} AS whisker_low,
  {_r("greatest(max(value) FILTER (inside), any_value(q3))")} AS whisker_high,
  CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers
FROM t GROUP BY {keys}"""


def build() -> dict[str, str]:
    """SQL by query name."""
    sources = f"{PRICES},{PURCHASES},{SALES},{INVOICES}"

    def src(body: str) -> str:
        return f"WITH {sources} {body}"

    def summ(body: str, *ctes: str) -> str:
        return f"WITH {','.join([sources, SUMMARY, *ctes])} {body}"

    def good(body: str, *ctes: str) -> str:
        return summ(body, GOOD, *ctes)

    rounded = ", ".join(f"{_r(c)} AS {c}" for c in ("ProfitMargin", "StockTurnover", "SalesPurchaseRatio"))
    clean = f"SELECT * REPLACE ({rounded}) FROM "
    vendor = {"purchases": "VendorNumber", "purchase_prices": "VendorNumber",
              "vendor_invoice": "VendorNumber", "sales": "VendorNo"}
    order = "TotalPurchaseDollars DESC, VendorNumber, Brand, PurchasePrice, ActualPrice, Volume NULLS FIRST"
    sql: dict[str, str] = {}

    # sources and sinks
    for name, cols in SOURCE_COLUMNS.items():
        sql[f"scan_{name}"] = src(f"SELECT {cols} FROM {name}")
        sql[f"vendor_rows_{name}"] = src(f"SELECT {cols} FROM {name} WHERE {vendor[name]} = 5")
    sql["csv_import_prices"] = sql["scan_purchase_prices"]
    sql["csv_import_invoices"] = (
        "SELECT o_orderkey AS PO_Number, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS Invoice_Date, o_totalprice AS Total_Price, "
        "CAST(o_custkey % 2 = 0 AS INT) AS Even, o_orderpriority AS Priority FROM orders"
    )
    sql["csv_import_status"] = src(
        """
SELECT 'begin_inventory' AS "table", 'error' AS status, CAST(0 AS BIGINT) AS rows
UNION ALL SELECT 'end_inventory', 'skipped', 0
UNION ALL SELECT 'purchase_prices', 'loaded', count(*) FROM purchase_prices
UNION ALL SELECT 'purchases', 'loaded', count(*) FROM purchases
UNION ALL SELECT 'sales', 'loaded', count(*) FROM sales
UNION ALL SELECT 'vendor_invoice', 'loaded', count(*) FROM vendor_invoice"""
    )
    # as the writer saw them: a wide key, long texts, dates, numbers of which some cells are no numbers
    sql["csv_column_report"] = """
WITH t AS (SELECT max(o_orderkey + 3000000000) AS k, max(length(repeat(o_orderpriority, 80))) AS w,
                  max(length(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR))) FILTER (o_custkey % 7 <> 0) AS d,
                  CAST(count(*) FILTER (o_custkey % 7 = 0) AS BIGINT) AS lost FROM orders)
SELECT 'Key' AS "column", 'bigint' AS type, '' AS width, CAST(0 AS BIGINT) AS lost FROM t
UNION ALL SELECT 'Note', 'string', CASE WHEN w <= 1000 THEN 'varchar(' || w || ')' ELSE 'text' END, 0 FROM t
UNION ALL SELECT 'Day', 'date', '', 0 FROM t
UNION ALL SELECT 'Cents', 'decimal(' || greatest(12, d + 4) || ',4)', '', lost FROM t"""
    sql["summary_sink"] = summ(f"{clean} summary")
    sql["ensure_table"] = summ(f"{clean} summary")

    # profiling
    sql["table_counts"] = src(
        " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in SOURCE_COLUMNS)
    )
    sql["catalog_counts"] = sql["table_counts"]
    sql["schema_profile"] = summ(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count(*) - count({c}) AS nulls FROM raw"
            for i, (c, t) in enumerate(SUMMARY_TYPES[:14], start=1)
        )
    )
    sql["distinct_vendor_names"] = summ("SELECT DISTINCT VendorName FROM raw")
    sql["distinct_descriptions"] = summ("SELECT DISTINCT Description FROM raw")
    sql["po_count"] = src("SELECT count(DISTINCT PONumber) AS \"distinct\" FROM vendor_invoice")
    sql["describe_summary"] = summ(
        f"""SELECT "column", count(value) AS count, {_r("avg(value)")} AS mean, {_r("stddev_samp(value)")} AS std,
  {_r("min(value)")} AS min, {_r("quantile_cont(value, 0.25)")} AS q25, {_r("quantile_cont(value, 0.5)")} AS q50,
  {_r("quantile_cont(value, 0.75)")} AS q75, {_r("max(value)")} AS max FROM long GROUP BY "column" """,
        _long("summary"),
    )
    sql["key_audit"] = summ(
        """
SELECT 'prices' AS "check", count(*) AS violations FROM (SELECT 1 FROM purchase_prices GROUP BY VendorNumber, Brand HAVING count(*) > 1)
UNION ALL SELECT 'invoices', count(*) FROM (SELECT 1 FROM vendor_invoice GROUP BY VendorNumber, PONumber HAVING count(*) > 1)
UNION ALL SELECT 'summary', count(*) FROM (SELECT 1 FROM summary GROUP BY VendorNumber, Brand HAVING count(*) > 1)
UNION ALL SELECT 'strict summary', count(*) FROM (SELECT 1 FROM strict_summary GROUP BY VendorNumber, Brand HAVING count(*) > 1)""",
        STRICT,
    )
    sql["summary_key_violations"] = summ(
        "SELECT VendorNumber, Brand, count(*) AS count FROM summary GROUP BY VendorNumber, Brand HAVING count(*) > 1"
    )
    for name, col in (("vendor_row_counts", "VendorName"), ("description_row_counts", "Description")):
        sql[name] = good(f"SELECT {col}, count(*) AS count FROM good GROUP BY {col} ORDER BY count DESC, {col} LIMIT 10")

    # aggregates and joins
    sql["freight_summary"] = src(
        "SELECT VendorNumber, CAST(SUM(Freight) AS DOUBLE) AS FreightCost FROM vendor_invoice GROUP BY VendorNumber"
    )
    totals = (
        "CAST(SUM(Quantity) AS BIGINT) AS TotalPurchaseQuantity, "
        "CAST(SUM(Dollars) AS DOUBLE) AS TotalPurchaseDollars"
    )
    bought = (
        "SELECT VendorNumber, VendorName, Brand, Description, PurchasePrice::DOUBLE AS PurchasePrice, "
        f"Price::DOUBLE AS ActualPrice, Volume, {totals} "
        "FROM purchases JOIN {offers} WHERE PurchasePrice > 0 GROUP BY ALL"
    )
    sql["purchase_summary"] = src(bought.format(offers=OFFERS))
    sql["purchase_summary_strict"] = src(bought.format(offers=STRICT_OFFERS))
    sql["purchase_summary_max"] = src(
        "SELECT VendorNumber, VendorName, Brand, MAX(PurchasePrice)::DOUBLE AS PurchasePrice, "
        f"MAX(Volume) AS Volume, MAX(Price)::DOUBLE AS ActualPrice, {totals} "
        f"FROM purchases JOIN {OFFERS} WHERE PurchasePrice > 0 GROUP BY ALL"
    )
    sql["sales_summary"] = src(
        """SELECT VendorNo AS VendorNumber, Brand, CAST(SUM(SalesQuantity) AS BIGINT) AS TotalSalesQuantity,
  CAST(SUM(SalesDollars) AS DOUBLE) AS TotalSalesDollars, CAST(SUM(SalesPrice) AS DOUBLE) AS TotalSalesPrice,
  CAST(SUM(ExciseTax) AS DOUBLE) AS TotalExciseTax FROM sales GROUP BY VendorNo, Brand"""
    )
    sql["purchase_summary_max_ordered"] = sql["purchase_summary_max"] + " ORDER BY TotalPurchaseDollars DESC, VendorNumber, Brand"
    sql["sales_summary_ordered"] = sql["sales_summary"] + " ORDER BY TotalSalesDollars DESC, VendorNumber, Brand"
    sql["purchases_by_brand_price"] = src(
        """SELECT Brand, CAST(PurchasePrice AS DOUBLE) AS PurchasePrice, CAST(SUM(Quantity) AS BIGINT) AS Quantity,
  CAST(SUM(Dollars) AS DOUBLE) AS Dollars FROM purchases GROUP BY Brand, PurchasePrice"""
    )
    sql["sales_by_brand"] = src(
        """SELECT Brand, CAST(SUM(SalesDollars) AS DOUBLE) AS SalesDollars, CAST(SUM(SalesPrice) AS DOUBLE) AS SalesPrice,
  CAST(SUM(SalesQuantity) AS BIGINT) AS SalesQuantity FROM sales GROUP BY Brand"""
    )
    sums = ", ".join(
        f"SUM({column})::DOUBLE AS {name}"
        for column, name in (
            ("SalesQuantity", "TotalSalesQuantity"), ("SalesDollars", "TotalSalesDollars"),
            ("SalesPrice", "TotalSalesPrice"), ("ExciseTax", "TotalExciseTax"),
            ("Quantity", "TotalPurchaseQuantity"), ("Dollars", "TotalPurchaseDollars"),
            ("Freight", "TotalFreightCost"),
        )
    )
    sql["fanout_summary"] = src(
        f"SELECT VendorNumber, Brand, Price::DOUBLE AS ActualPrice, PurchasePrice::DOUBLE AS PurchasePrice, {sums} "
        "FROM purchase_prices JOIN (SELECT * RENAME (VendorNo AS VendorNumber) FROM sales) USING (VendorNumber, Brand) "
        "JOIN (SELECT VendorNumber, Quantity, Dollars, Freight FROM vendor_invoice) USING (VendorNumber) GROUP BY ALL"
    )
    sql["vendor_summary"] = summ("SELECT * FROM raw")
    sql["clean_summary"] = summ(f"{clean} summary")
    sql["strict_summary"] = summ(f"{clean} strict_summary", STRICT)
    sql["summary_head"] = summ(f"{clean} summary ORDER BY {order} LIMIT 5")

    # questions
    sql["profitable_rows"] = good(f"{clean} good")
    sql["kpis"] = good(
        f"""SELECT {_sum("TotalSalesDollars")} AS TotalSales, {_sum("TotalPurchaseDollars")} AS TotalPurchases,
  {_sum("GrossProfit")} AS GrossProfit, {_r("AVG(ProfitMargin)")} AS AvgProfitMargin, {_sum(UNSOLD)} AS UnsoldCapital FROM good"""
    )
    sql["brand_performance"] = good(
        f"SELECT Description, TotalSalesDollars, {_r('ProfitMargin')} AS ProfitMargin FROM brands", BRANDS
    )
    sql["capped_brands"] = good(
        f"SELECT Description, TotalSalesDollars, {_r('ProfitMargin')} AS ProfitMargin FROM brands WHERE TotalSalesDollars < 1000000",
        BRANDS,
    )
    sql["target_brands"] = good(
        f"""SELECT Description, TotalSalesDollars, {_r('ProfitMargin')} AS ProfitMargin FROM brands, limits
WHERE TotalSalesDollars <= low AND ProfitMargin >= high""",
        BRANDS,
    )
    sql["brand_scatter"] = good(
        f"""SELECT Description, TotalSalesDollars, {_r('ProfitMargin')} AS ProfitMargin, {_r('low')} AS LowSalesThreshold,
  {_r('high')} AS HighMarginThreshold, TotalSalesDollars <= low AND ProfitMargin >= high AS IsTarget
FROM brands, limits WHERE TotalSalesDollars < 1000000""",
        BRANDS,
    )
    sql["top_vendors"] = good(
        f"""SELECT VendorName, {_sum("TotalSalesDollars")} AS TotalSalesDollars FROM good GROUP BY VendorName
ORDER BY TotalSalesDollars DESC, VendorName LIMIT 10"""
    )
    sql["top_brands"] = good(
        f"""SELECT Description, TotalSalesDollars, {_text("TotalSalesDollars")} AS SalesText FROM brands
ORDER BY TotalSalesDollars DESC, Description LIMIT 10""",
        BRANDS,
    )
    sql["vendor_performance"] = good(
        f"""SELECT VendorName, {_sum("TotalPurchaseDollars")} AS TotalPurchaseDollars, {_sum("GrossProfit")} AS GrossProfit,
  {_sum("TotalSalesDollars")} AS TotalSalesDollars FROM good GROUP BY VendorName"""
    )
    for name, by in (("vendor_contribution", "VendorName"), ("brand_contribution", "Description")):
        sql[name] = good(
            f"""SELECT {by}, {_r("bought", 2)} AS TotalPurchaseDollars, {_r("profit", 2)} AS GrossProfit,
  {_r("sold", 2)} AS TotalSalesDollars, {_r("share", 2)} AS "PurchaseContribution%" FROM shares""",
            _SHARES.format(by=by),
        )
    shares = (_SHARES.format(by="VendorName"), LEADERS)
    running = _r("SUM(share) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING)", 2)
    sql["pareto"] = good(
        f"""SELECT VendorName, {_text("bought")} AS TotalPurchaseDollars, {_text("profit")} AS GrossProfit,
  {_text("sold")} AS TotalSalesDollars, share AS "PurchaseContribution%", {running} AS "CumulativeContribution%" FROM leaders""",
        *shares,
    )
    sql["top_contribution"] = good(f'SELECT {_r("SUM(share)", 2)} AS "TopContribution%" FROM leaders', *shares)
    sql["contribution_with_other"] = good(
        f"""SELECT CAST(pos AS INT) AS Position, VendorName, share AS "PurchaseContribution%" FROM leaders
UNION ALL SELECT CAST(count(*) + 1 AS INT), 'Other Vendors', {_r("100 - SUM(share)", 2)} FROM leaders""",
        *shares,
    )
    sql["slow_vendors"] = good(
        f"""SELECT VendorName, {_r("m")} AS StockTurnover FROM (
  SELECT VendorName, AVG(StockTurnover) AS m FROM good WHERE StockTurnover < 1 GROUP BY VendorName ORDER BY m, VendorName LIMIT 10)"""
    )
    sql["locked_capital"] = good(
        f"""SELECT VendorName, {_text("v")} AS UnsoldInventoryValue FROM (
  SELECT VendorName, {_sum(UNSOLD)} AS v FROM good GROUP BY VendorName ORDER BY v DESC, VendorName LIMIT 10)"""
    )
    sql["total_locked_capital"] = good(
        f"SELECT v AS UnsoldInventoryValue, {_text('v')} AS UnsoldInventoryText FROM (SELECT {_sum(UNSOLD)} AS v FROM good)"
    )
    row_keys = "VendorNumber, Brand, PurchasePrice, ActualPrice, Volume"
    sql["order_size"] = good(
        f"""SELECT {row_keys}, TotalPurchaseQuantity, {_r("TotalPurchaseDollars / TotalPurchaseQuantity")} AS UnitPurchasePrice,
  {_r(UNSOLD)} AS UnsoldInventoryValue, CAST(rank AS INT) AS OrderSizeRank, {SIZE_NAME} AS OrderSize FROM sized""",
        SIZED,
    )
    sql["unit_price_by_order_size"] = good(
        f"""SELECT {SIZE_NAME} AS OrderSize, {_r("AVG(TotalPurchaseDollars / TotalPurchaseQuantity)")} AS UnitPurchasePrice
FROM sized GROUP BY rank""",
        SIZED,
    )
    sql["money_text"] = summ(
        f"SELECT VendorNumber, Brand, ActualPrice, Volume, {_text('GrossProfit')} AS ProfitText, {_text('TotalSalesDollars')} AS SalesText FROM summary"
    )

    # statistics
    sql["quantiles"] = good(
        f"""SELECT "column", count(*) AS n, p, {_r("any_value(q)")} AS quantile FROM (
  SELECT "column", p, quantile_cont(value, 0.15) OVER w AS a, quantile_cont(value, 0.25) OVER w AS b,
    quantile_cont(value, 0.75) OVER w AS c, quantile_cont(value, 0.85) OVER w AS d,
    CASE p WHEN 0.15 THEN a WHEN 0.25 THEN b WHEN 0.75 THEN c ELSE d END AS q
  FROM long, (VALUES (0.15::DOUBLE), (0.25::DOUBLE), (0.75::DOUBLE), (0.85::DOUBLE)) AS ps(p) WINDOW w AS (PARTITION BY "column", p))
GROUP BY "column", p""",
        _long("good"),
    )
    histogram, histogram_tables = _histogram()
    sql["histogram_summary"] = summ(histogram, _long("summary"), histogram_tables)
    sql["histogram_profitable"] = good(histogram, _long("good"), histogram_tables)
    density, shape = _density()
    sql["density_summary"] = summ(density, _long("summary"), shape)
    sql["density_curves"] = good(density, _long("good"), shape)
    by_cohort = 'cohort, "column"'
    histogram, histogram_tables = _histogram(by_cohort)
    sql["histogram_cohorts"] = good(histogram, COHORT_EDGES, COHORT_LONG, histogram_tables)
    density, shape = _density(by_cohort)
    sql["density_cohorts"] = good(density, COHORT_EDGES, COHORT_LONG, shape)
    sql["box_summary"] = summ(_box('"column"'), _long("summary"))
    sql["box_unit_price"] = good(
        _box('OrderSize, "column"'),
        SIZED,
        f"""long AS (SELECT {SIZE_NAME} AS OrderSize, 'UnitPurchasePrice' AS "column",
                     TotalPurchaseDollars / TotalPurchaseQuantity AS value FROM sized)""",
    )
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {_r(f'corr({a}, {b})')} AS r FROM good"
        for a in NUMERIC
        for b in NUMERIC
    )
    sql["correlation_matrix"] = good(pairs)
    sql["margin_ci"] = good(
        f"""SELECT n, {_r("mean")} AS mean, {_r(f"mean - {_t975('(n - 1)')} * sd / sqrt(n)")} AS lower,
  {_r(f"mean + {_t975('(n - 1)')} * sd / sqrt(n)")} AS upper
FROM (SELECT count(ProfitMargin) AS n, avg(ProfitMargin) AS mean, stddev_samp(ProfitMargin) AS sd FROM good)"""
    )
    sql["margin_ci_top_low"] = good(_ci(">="), COHORT_EDGES)
    sql["margin_ci_top_low_strict"] = good(_ci("<="), COHORT_EDGES)
    sql["welch_test"] = good(WELCH, COHORT_EDGES)
    return sql
