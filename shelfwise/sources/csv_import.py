"""CSV files to typed tables.

A file is scanned as text, types are chosen from one aggregate over all cells,
and the typed columns are written, with rows and lost cells counted on the way: two
scans. Only one row of statistics reaches the driver. A file whose rows do not fit
its header is refused, not cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from shelfwise.sources import csv_records
from shelfwise.sources.tables import clustered, layout_options, write_table

# File and table names of the import.
FILES = {
    "begin_inventory.csv": "begin_inventory",
    "end_inventory.csv": "end_inventory",
    "purchase_prices.csv": "purchase_prices",
    "purchases.csv": "purchases",
    "sales.csv": "sales",
    "vendor_invoice.csv": "vendor_invoice",
}

#: Columns that questions filter the tables by; imported tables are clustered on those that they have.
CLUSTER_BY = ("VendorNumber", "VendorNo")

# Cell texts that a data-frame CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Date forms, each with the texts it is tried on.
DATE_FORMS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}T", "yyyy-M-d'T'H:m[:s]"),
    (r"^\d{4}-\d", "yyyy-M-d[ H:m[:s]]"),
    (r"^\d{4}/\d", "yyyy/M/d[ H:m[:s]]"),
    (r"^\d{1,2}-\d{1,2}-\d{4}", "d-M-yyyy[ H:m[:s]]"),
    (r"^\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy[ H:m[:s]]"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}", "d.M.yyyy[ H:m[:s]]"),
    (r"^\d{1,2}-\d{1,2}-\d{2}( |$)", "d-M-yy[ H:m[:s]]"),
    (r"^\d{1,2}/\d{1,2}/\d{2}( |$)", "d/M/yy[ H:m[:s]]"),
    (r"^\d{1,2}\.\d{1,2}\.\d{2}( |$)", "d.M.yy[ H:m[:s]]"),
    (r"^\d{1,2}-\p{Alpha}{3}-\d{4}", "d-MMM-yyyy"),
    (r"^\d{1,2} \p{Alpha}{3} \d{4}", "d MMM yyyy"),
    (r"^\d{1,2}-\p{Alpha}{4,}-\d{4}", "d-MMMM-yyyy"),
    (r"^\d{1,2} \p{Alpha}{4,} \d{4}", "d MMMM yyyy"),
    (r"^\p{Alpha}{3} \d{1,2}, \d{4}", "MMM d, yyyy"),
    (r"^\p{Alpha}{4,} \d{1,2}, \d{4}", "MMMM d, yyyy"),
)

# Texts that read as a whole number and as a number.
INTEGER = r"^[+-]?\d+$"
DECIMAL = r"^[+-]?\d+(\.\d+)?$"
#: Whole numbers and fractions that need no trimming: no date form and no exponent fits these.
PLAIN = r"\A[+-]?[0-9]+(\.[0-9]+)?\z"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")
INT_MAX, LONG_MAX = 2147483647, 9223372036854775807


@dataclass(frozen=True)
class ColumnRule:
    """How one text column becomes a typed one."""

    name: str
    kind: str
    type: DataType
    max_length: int
    known: int
    lost: int = 0

    def typed(self) -> str:
        """SQL of the typed column; cells that do not fit the kind become null."""
        cell = _quoted(self.name)
        if self.kind == "bool":
            value = f"CAST(lower({cell}) = 'true' AS INT)"
        elif self.kind in ("int", "decimal"):
            value = _number(cell, self.type.simpleString())
        elif self.kind == "date":
            value = _date(cell)
        else:
            value = cell
        return f"{value} AS {cell}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _matches(cell: str, pattern: str) -> str:
    return f"{cell} RLIKE r'{pattern}'"


def _number(cell: str, kind: str) -> str:
    """The cell as a number of a type, null if it is none or does not fit."""
    return f"CASE WHEN {_matches(cell, NUMBER)} THEN try_cast(trim({cell}) AS {kind}) END"


def _date(cell: str) -> str:
    """Year-first or day-first date; each text is parsed with one form only."""
    cases = " ".join(
        f"WHEN {_matches(f'trim({cell})', pattern)} THEN try_to_date(trim({cell}), \"{form}\")"
        for pattern, form in DATE_FORMS
    )
    return f"CASE {cases} END"


class MalformedFile(ValueError):
    """The rows of a file do not fit its header."""


def read_csv_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All columns as text, first line as header, byte-order mark dropped.

    Texts that stand for a missing value are null, and so are the cells that a
    short row lacks. A row with more cells than the header raises
    :class:`MalformedFile`. Line breaks inside quotes need no setting and keep the
    file split over tasks; ``multiline`` spares the scan that looks for them.
    """
    return _survey(spark, path, multiline, statistics=False)[0]


def _survey(spark: SparkSession, path: str, multiline: bool, statistics: bool) -> tuple[DataFrame, dict[str, dict]]:
    """The text columns of a file and, if wanted, the statistics of its cells.

    One scan takes every line for a record, counts what speaks against that, and
    makes the statistics. Where a cell goes over lines, or a line of data equals the
    header, records are put together first and scanned instead.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("encoding", "UTF-8")
    if not multiline:
        names = reader.csv(path).columns
        lines = csv_records.read_lines(spark, path).where("length(trim(line)) > 0")
        first = lines.where("block = 0").select("line").first()
        header = (F.col("block") == 0) & (F.col("line") == (first[0] if first else ""))
        cells = _cells(lines.select(header.alias("header"), csv_records.opens().alias("open"), F.col("line").alias("record")), names)
        counts, stats = _measure(cells, statistics)
        if not counts["open"] and counts["header"] == len(spark.read.text(path).inputFiles()):
            _refuse_extra_cells(counts["extra"])
            return cells.where(f"NOT {FLAGS}.header").drop(FLAGS), stats
    names = reader.option("multiLine", True).csv(path).columns
    no = F.lit(False)
    cells = _cells(csv_records.records(spark, path).select(no.alias("header"), no.alias("open"), "record"), names)
    counts, stats = _measure(cells, statistics)
    _refuse_extra_cells(counts["extra"])
    return cells.drop(FLAGS), stats


def _cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Cells of records (header, open, record) as text columns, null where missing, and the flags as ``FLAGS``."""
    shape = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{CORRUPT} string"])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = rows.select("*", F.when(~F.col("header"), F.from_csv("record", shape, options)).alias("cells"))
    # Rows that do not fit the schema are kept as text: short ones and those with more cells.
    # A condition of its own: what stands twice behind an "and" is worked out for every row.
    extra = F.when(F.col(f"cells.{CORRUPT}").isNotNull(), csv_records.n_cells(F.col("record")) > len(names)).otherwise(False)
    missing = ", ".join(f"'{text}'" for text in MISSING_TEXTS)
    known = [
        F.expr(f"CASE WHEN cells.c{i} NOT IN ({missing}) THEN cells.c{i} END").alias(name)
        for i, name in enumerate(_normalized(names))
    ]
    return parsed.select(*known, F.struct("header", "open", extra.alias("extra")).alias(FLAGS))


def _measure(cells: DataFrame, statistics: bool) -> tuple[dict[str, int], dict[str, dict]]:
    """Counts of headers, open lines and rows with too many cells; statistics of the columns if wanted. One scan."""
    names = [c for c in cells.columns if c != FLAGS]
    flags = {f: F.coalesce(f"{FLAGS}.{f}", F.lit(False)) for f in ("header", "open", "extra")}
    if not (statistics and names):
        return cells.agg(*[F.count_if(flag).alias(f) for f, flag in flags.items()]).first().asDict(), {}
    # the flags of a row stand with each of its cells, and are counted with the first
    found = _statistics(cells, names, {f: F.count_if(flag & (F.col(PLACE) == 0)).alias(f) for f, flag in flags.items()})
    counts = {f: found[names[0]][f] for f in flags}
    for stat in found.values():
        stat["rows"] -= counts["header"]
    return counts, found


CORRUPT, FLAGS, PLACE, CELL = "_corrupt_record", "_flags", "_place", "_cell"


def _refuse_extra_cells(rows: int) -> None:
    if rows:
        raise MalformedFile(f"{rows} rows have more cells than the header")


def _normalized(names: Sequence[str]) -> list[str]:
    return ["_".join(name.lstrip("\ufeff").split()) for name in names]


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip column names and join their words with underscores."""
    return df.toDF(*_normalized(df.columns))


def infer_rules(raw: DataFrame, threshold: float = 0.6) -> list[ColumnRule]:
    """Choose a type for every column from all its known cells.

    A column is numeric if all its cells are numbers, or if a share of
    ``threshold`` reads as one. It is an integer if all its cells are whole.
    Other columns are dates if such a share parses, and text otherwise. Scale
    follows the longest fraction, width the largest number.
    """
    return _rules(_statistics(raw, raw.columns), threshold)


def _rules(stats: dict[str, dict], threshold: float = 0.6) -> list[ColumnRule]:
    rules = []
    for name, stat in stats.items():
        known, numbers = stat["known"], stat["numbers"]
        kind, chosen = "text", StringType()
        if known and known == stat["rows"] == stat["booleans"]:
            kind, chosen = "bool", IntegerType()
        elif known and numbers and (numbers == known or stat["decimals"] >= threshold * known):
            whole = stat["wholes"] == known
            kind = "int" if whole else "decimal"
            chosen = _int_type(stat) if whole else _decimal_type(stat)
        elif known and stat["dates"] >= threshold * known:
            kind, chosen = "date", DateType()
        rules.append(ColumnRule(name, kind, chosen, stat["length"], known))
    return rules


def _statistics(df: DataFrame, names: Sequence[str], more: Mapping[str, Column] | None = None) -> dict[str, dict]:
    """Counts over all rows for each column, with ``more`` aggregates of the rows (place, cell, flags) of its cells.

    Cells are counted one below the other, so that the expressions do not grow with
    the number of columns. Plain numbers are told by one pattern, and no other is tried
    on them; date forms are tried only on cells that begin like one of them.
    """
    if not names:
        return {}
    more = dict(more or {})
    cells = F.posexplode(F.array(*[F.col(_quoted(n)) for n in names])).alias(PLACE, CELL)
    rows = df.select(cells, *([F.col(FLAGS)] if FLAGS in df.columns else []))
    rows = rows.withColumn("low", F.expr(f"coalesce(ascii({CELL}) <= ascii('9'), false)"))
    rows = rows.withColumn("plain", F.expr(f"low AND {_matches(CELL, PLAIN)}"))
    rows = rows.withColumn("number", F.expr(f"plain OR (low AND {_matches(CELL, NUMBER)})"))
    text = f"trim({CELL})"
    rows = rows.withColumn("value", F.expr(f"CASE WHEN number THEN try_cast({text} AS double) END"))
    power = f"coalesce(try_cast(regexp_extract({text}, '[eE]([+-]?[0-9]+)$', 1) AS INT), 0)"
    fraction = f"length(regexp_extract({text}, '[.]([0-9]*?)0*([eE]|$)', 1))"
    whole = f"length(regexp_extract({text}, '^[+-]?0*([0-9]*)', 1))"
    plain_fraction = f"CASE WHEN contains({CELL}, '.') THEN length(rtrim('0', substring_index({CELL}, '.', -1))) ELSE 0 END"
    plain_whole = f"length(ltrim('+-0', substring_index({CELL}, '.', 1)))"
    flags = ", ".join(f"'{text}'" for text in BOOLEANS)
    # anchored as a whole: alternatives would be tried at every place of the cell
    dated = f"^(?:{'|'.join(pattern for pattern, _ in DATE_FORMS)})"
    fields = {
        "rows": "count(1)",
        "known": f"count({CELL})",
        "length": f"coalesce(max(length({CELL})), 0)",
        "numbers": "count(value)",
        "decimals": f"count_if(CASE WHEN plain THEN true WHEN low THEN {_matches(text, DECIMAL)} END)",
        "wholes": f"count_if(CASE WHEN plain THEN NOT contains({CELL}, '.') WHEN low THEN {_matches(text, INTEGER)} END)",
        "largest": "max(abs(value))",
        "scale": f"coalesce(max(CASE WHEN plain THEN {plain_fraction} WHEN number THEN greatest(0, {fraction} - {power}) END), 0)",
        "digits": f"coalesce(max(CASE WHEN plain THEN {plain_whole} WHEN number THEN greatest(0, {whole} + {power}) END), 0)",
        "booleans": f"count_if({CELL} IN ({flags}))",
        "dates": f"count(CASE WHEN NOT plain AND {_matches(text, dated)} THEN {_date(CELL)} END)",
    }
    found = rows.groupBy(PLACE).agg(*[F.expr(sql).alias(f) for f, sql in fields.items()], *more.values()).collect()
    # without rows no column is found
    none = dict.fromkeys([*fields, *more], 0) | {"largest": None}
    return {name: none.copy() for name in names} | {names[r[PLACE]]: r.asDict() for r in found}


def _int_type(stat: dict) -> DataType:
    if stat["largest"] <= INT_MAX:
        return IntegerType()
    if stat["largest"] < LONG_MAX:
        return LongType()
    return DecimalType(38, 0) if stat["digits"] <= 38 else DoubleType()


def _decimal_type(stat: dict) -> DataType:
    """Four decimals and twelve digits, more of both where the numbers need them."""
    scale = max(4, stat["scale"])
    digits = max(12, stat["digits"] + scale)
    return DecimalType(digits, scale) if digits <= 38 else DoubleType()


def measure_lost(typed: DataFrame, rules: list[ColumnRule]) -> list[ColumnRule]:
    """The rules with the number of known cells that are null in the typed table."""
    row = typed.agg(*[F.count(F.col(_quoted(r.name))).alias(f"c{i}") for i, r in enumerate(rules)]).first()
    return [replace(r, lost=r.known - row[i]) for i, r in enumerate(rules)]


def choose_types(raw: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """The typed table."""
    return raw.selectExpr(*[rule.typed() for rule in rules])


def column_report(spark: SparkSession, rules: list[ColumnRule]) -> DataFrame:
    """Chosen type, text width and number of cells lost per column."""
    rows = [(r.name, r.type.simpleString(), _width(r), r.lost) for r in rules]
    return spark.createDataFrame(rows, "column string, type string, width string, lost bigint")


def _width(rule: ColumnRule) -> str:
    """Text width class a fixed-width store would need."""
    if rule.kind != "text":
        return ""
    if rule.max_length <= 191:
        return f"varchar({max(1, rule.max_length)})"
    return f"varchar({rule.max_length})" if rule.max_length <= 1000 else "text"


def load_csv(
    spark: SparkSession, path: str, target: str, multiline: bool = False, cluster_by: Sequence[str] = ()
) -> list[ColumnRule]:
    """Import one file into a target and return its column rules, with the cells lost.

    The target is clustered on those of the columns ``cluster_by`` that it has, at
    the price of a shuffle and of another scan that finds the ranges.
    """
    return _load(spark, path, target, multiline, cluster_by)[0]


def _load(
    spark: SparkSession, path: str, target: str, multiline: bool, cluster_by: Sequence[str] = ()
) -> tuple[list[ColumnRule], int]:
    """Column rules with the cells lost, and rows written; both are counted while the target is written."""
    raw, stats = _survey(spark, path, multiline, statistics=True)
    rules = _rules(stats)
    written = Observation()
    known = [F.count(F.col(_quoted(r.name))).alias(f"c{i}") for i, r in enumerate(rules)]
    typed, keys = choose_types(raw, rules), [c for c in cluster_by if c in raw.columns]
    if keys:  # counted above the shuffle: below it a scan that finds the ranges would be counted too
        typed = clustered(typed, keys)
    write_options = layout_options(keys) if keys else {}
    write_table(typed.observe(written, F.count(F.lit(1)).alias("rows"), *known), target, options=write_options)
    counts = written.get
    return [replace(r, lost=r.known - counts[f"c{i}"]) for i, r in enumerate(rules)], counts["rows"]


STATUS = StructType(
    [
        StructField("table", StringType(), False),
        StructField("status", StringType(), False),
        StructField("rows", LongType()),
        StructField("lost", LongType()),
        StructField("message", StringType()),
    ]
)


def import_tables(
    spark: SparkSession,
    folder: str,
    target_folder: str | None = None,
    files: Mapping[str, str] = FILES,
    multiline: bool = False,
    at_once: int = 4,
    cluster_by: Sequence[str] = CLUSTER_BY,
) -> DataFrame:
    """Import a set of files, replacing the tables; rows (table, status, rows, lost, message).

    A missing file is skipped and a failing one reported; neither stops the rest,
    and the table of a failing file stays as it was. With ``target_folder`` tables
    are written below it, else to the catalog. ``at_once`` files are imported at a
    time, each in a scheduler pool named after its table. Tables are clustered on
    those of the columns ``cluster_by`` that they have.
    """

    def one(file: str, table: str) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        target = f"{target_folder}/{table}" if target_folder else table
        try:
            rules, rows = _load(spark, f"{folder}/{file}", target, multiline, cluster_by)
            return table, "loaded", rows, sum(r.lost for r in rules), None
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            return table, "skipped" if missing else "error", None, None, str(error).splitlines()[0]
        except Exception as error:  # one bad file must not stop the others
            return table, "error", None, None, (str(error) or repr(error)).splitlines()[0]

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # each thread gets the scratch scopes and local properties of this one
        waiting = [pool.submit(copy_context().run, inheritable_thread_target(spark)(one), *f) for f in files.items()]
        report = [w.result() for w in waiting]
    return spark.createDataFrame(report, STATUS)
