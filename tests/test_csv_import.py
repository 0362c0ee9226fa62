import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
)

from shelfwise.sources import csv_import as ci


def write(path, text, bom=False):
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def load(spark, path, **kw):
    raw = ci.read_csv_raw(spark, path, **kw)
    rules = ci.infer_rules(raw)
    typed = ci.choose_types(raw, rules)
    return {r.name: r for r in ci.measure_lost(typed, rules)}, typed.collect()


def column(tmp_path, spark, values):
    rules, rows = load(spark, write(tmp_path / "c.csv", "v,w\n" + "".join(f"{v},x\n" for v in values)))
    return rules["v"], [r.v for r in rows]


def test_header_and_missing_cells(spark, tmp_path):
    path = write(tmp_path / "p.csv", ' Brand Name ,Size\t ml,Note\nRum,750,"say ""hi"", ok"\nNA,,null\n', bom=True)
    raw = ci.read_csv_raw(spark, path)
    assert raw.columns == ["Brand_Name", "Size_ml", "Note"]
    assert [tuple(r) for r in raw.collect()] == [("Rum", "750", 'say "hi", ok'), (None, None, None)]


def test_line_break_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n1,"x\ny"\n2,z\n')
    _, rows = load(spark, path, multiline=True)
    assert [(r.a, r.b) for r in rows] == [(1, "x\ny"), (2, "z")]


def test_integers(spark, tmp_path):
    rule, values = column(tmp_path, spark, [1, -5, "+7", ""])
    assert rule.type == IntegerType() and values == [1, -5, 7, None]
    rule, values = column(tmp_path, spark, [1, 2147483648])
    assert rule.type == LongType() and values == [1, 2147483648]
    rule, values = column(tmp_path, spark, [1, 10**20])
    assert rule.type == DecimalType(38, 0) and values == [1, Decimal(10**20)]


def test_fractions(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["12.5", "3", "1e2", ".25"])
    assert rule.type == DecimalType(12, 4) and values == [Decimal(v) for v in ("12.5", "3", "100", "0.25")]
    rule, values = column(tmp_path, spark, ["12345678901.25", "1.5"])  # widened, nothing lost
    assert rule.type == DecimalType(15, 4) and values[0] == Decimal("12345678901.25")
    rule, _ = column(tmp_path, spark, ["1e300", "2"])
    assert rule.type == DoubleType()


def test_mostly_numeric_text(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["750", "1750", "Unknown"])
    assert rule.type == DecimalType(12, 4) and values == [750, 1750, None] and rule.lost == 1
    late = ["8"] * 200 + ["Unknown"]
    rule, values = column(tmp_path, spark, late)
    assert rule.type == DecimalType(12, 4) and values.count(8) == 200 and rule.lost == 1
    late = ["8"] * 200 + ["1.5", "x"]  # a later fraction is kept
    rule, values = column(tmp_path, spark, late)
    assert rule.type == DecimalType(12, 4) and Decimal("1.5") in values


def test_late_cells_decide_too(spark, tmp_path):
    codes = [f"c{i}" for i in range(300)]
    for first in (list(range(30)), ["2024-01-05"] * 50):
        rule, values = column(tmp_path, spark, [*first, *codes])
        assert rule.type == StringType() and rule.lost == 0
        assert sorted(values) == sorted(map(str, [*first, *codes]))


def test_no_digit_is_lost(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["0.123456", "2.5"])
    assert rule.type == DecimalType(12, 6) and values == [Decimal("0.123456"), Decimal("2.5")]
    rule, values = column(tmp_path, spark, ["99999999.99999", "1"])
    assert rule.type == DecimalType(13, 5) and values[0] == Decimal("99999999.99999") and rule.lost == 0
    rule, values = column(tmp_path, spark, ["1.5e-7", "2e3"])
    assert rule.type == DecimalType(12, 8) and values == [Decimal("0.00000015"), Decimal(2000)]
    rule, values = column(tmp_path, spark, ["0." + "1" * 30, "123456789.5"])  # more than 38 digits
    assert rule.type == DoubleType() and rule.lost == 0


def test_rows_that_do_not_fit_the_header(spark, tmp_path):
    with pytest.raises(ci.MalformedFile, match="1 rows have more cells"):
        ci.read_csv_raw(spark, write(tmp_path / "e.csv", "a,b\n1,2\n3,4,5\n"))
    with pytest.raises(ci.MalformedFile, match="1 rows have more cells"):  # the row goes over two lines
        ci.read_csv_raw(spark, write(tmp_path / "q.csv", 'a,b\n1,"x\ny",3\n2,z\n'))
    raw = ci.read_csv_raw(spark, write(tmp_path / "r.csv", 'a,b\n1,"x\ny"\n2,z\n'))
    assert [tuple(r) for r in raw.collect()] == [("1", "x\ny"), ("2", "z")]
    raw = ci.read_csv_raw(spark, write(tmp_path / "s.csv", 'a,b\n1\n2,"x,y"\n'))  # a short row, a quoted comma
    assert [tuple(r) for r in raw.collect()] == [("1", None), ("2", "x,y")]


def test_half_numeric_stays_text(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["1", "a", "2", "b"])
    assert rule.type == StringType() and set(values) == {"1", "a", "2", "b"}


def test_flags(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["True", "false", "TRUE"])
    assert rule.type == IntegerType() and values == [1, 0, 1]
    rule, values = column(tmp_path, spark, ["True", ""])
    assert rule.type == StringType() and values == ["True", None]


def test_dates(spark, tmp_path):
    texts = ["31-12-2024", "05/01/2024", "2024-02-03", "2024-02-04 10:30:00", "7.3.2024", "8-Mar-2024", "soon"]
    rule, values = column(tmp_path, spark, texts)
    assert rule.type == DateType() and rule.lost == 1
    assert values == [
        dt.date(2024, 12, 31), dt.date(2024, 1, 5), dt.date(2024, 2, 3), dt.date(2024, 2, 4),
        dt.date(2024, 3, 7), dt.date(2024, 3, 8), None,
    ]
    rule, _ = column(tmp_path, spark, ["31-12-2024", "x", "y"])
    assert rule.type == StringType()
    rule, _ = column(tmp_path, spark, ["20240105", "20240106"])  # bare numbers stay numbers
    assert rule.type == IntegerType()


def test_more_date_forms(spark, tmp_path):
    texts = ["2024-01-05T10:00:00", "05/03/24", "6-3-24", "7.3.24", "8 March 2024", "9-September-2024"]
    rule, values = column(tmp_path, spark, texts)
    assert rule.type == DateType() and rule.lost == 0
    assert values == [
        dt.date(2024, 1, 5), dt.date(2024, 3, 5), dt.date(2024, 3, 6), dt.date(2024, 3, 7), dt.date(2024, 3, 8),
        dt.date(2024, 9, 9),
    ]
    rule, values = column(tmp_path, spark, ['"March 8, 2024"', '"Sep 9, 2024"'])
    assert values == [dt.date(2024, 3, 8), dt.date(2024, 9, 9)]


def test_sparse_column(spark, tmp_path):
    body = "".join(f"{i},{i / 4 if i > 300 else ''}\n" for i in range(400))
    rules, rows = load(spark, write(tmp_path / "s.csv", "id,v\n" + body))
    assert rules["v"].type == DecimalType(12, 4)
    assert sum(r.v is not None for r in rows) == 99


def test_empty_column_is_text(spark, tmp_path):
    rule, values = column(tmp_path, spark, ["", ""])
    assert rule.type == StringType() and values == [None, None]


def test_report(spark, tmp_path):
    path = write(tmp_path / "r.csv", f"a,b,c\n1,{'x' * 200},{'y' * 1200}\n")
    report = ci.column_report(spark, ci.infer_rules(ci.read_csv_raw(spark, path)))
    assert {r.column: (r.type, r.width) for r in report.collect()} == {
        "a": ("int", ""), "b": ("string", "varchar(200)"), "c": ("string", "text"),
    }


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "sales.csv", "VendorNo,SalesPrice\n1,2.5\n2,3.0\n")
    write(tmp_path / "begin_inventory.csv", "id,day\n1,2024-01-01\n")
    write(tmp_path / "extra.csv", "a,b\n3,4,5\n")
    (tmp_path / "purchases.csv.gz").write_bytes(b"this is no archive")
    return tmp_path


def test_import_of_a_file_set(spark, folder, tmp_path):
    files = {
        "purchases.csv.gz": "purchases", "sales.csv": "sales",
        "begin_inventory.csv": "begin_inventory", "end_inventory.csv": "end_inventory", "extra.csv": "extra",
    }
    out = str(tmp_path / "tables")
    for _ in range(2):  # the second run replaces the tables
        report = {r.table: r for r in ci.import_tables(spark, str(folder), out, files).collect()}
    assert {t: r.status for t, r in report.items()} == {
        "purchases": "error", "sales": "loaded", "begin_inventory": "loaded", "end_inventory": "skipped",
        "extra": "error",
    }
    assert report["sales"].rows == 2
    assert dict(spark.read.parquet(f"{out}/begin_inventory").dtypes) == {"id": "int", "day": "date"}


def test_statistics_do_not_grow_with_the_columns(spark, tmp_path, monkeypatch):
    """One set of patterns serves all columns; one set for each took 37 microseconds a cell."""
    plans = []

    def collect(df, collect=type(spark.range(1)).collect):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return collect(df)

    monkeypatch.setattr(type(spark.range(1)), "collect", collect)
    patterns = []
    for times in (1, 3):
        names = ",".join(f"c{i}" for i in range(4 * times))
        path = write(tmp_path / f"w{times}.csv", names + "\n" + ",".join(["1,x,2.5,2024-01-05"] * times) + "\n")
        plans.clear()
        _, stats = ci._survey(spark, path, False, statistics=True)
        assert [(stat["numbers"], stat["dates"]) for stat in stats.values()] == [(1, 0), (0, 0), (1, 0), (0, 1)] * times
        patterns.append(" ".join(plans).count("RLIKE"))
    assert patterns[0] == patterns[1]


def test_plain_numbers_and_others_count_alike(spark):
    cells = ["-007.50", " 12 ", "+3", "1e3", ".5", "5.", "12\n", "\t4", "2.5E-3", "0.0", "x1", "", " 5 Jan 2024", "Jan 5, 2024", "1.2.2024", "1.2.3.4", None]
    stat = ci._statistics(spark.createDataFrame([(c,) for c in cells], "v string"), ["v"])["v"]
    assert stat == stat | {"rows": 17, "known": 16, "length": 11, "numbers": 10, "decimals": 5, "wholes": 3, "largest": 1000.0}
    assert stat == stat | {"scale": 4, "digits": 4, "booleans": 0, "dates": 3}
    empty = ci._statistics(spark.createDataFrame([], "v string"), ["v"])["v"]
    assert empty["rows"] == empty["known"] == empty["length"] == 0 and empty["largest"] is None
