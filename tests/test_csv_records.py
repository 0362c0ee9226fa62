"""Records that go over lines, byte ranges and files; replacement of tables; files at a time."""

import csv
import io
import os
import random
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.session import scratch_scope, shared_dir
from shelfwise.sources import csv_import as ci
from shelfwise.sources import csv_records, tables


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.fixture
def small_ranges(spark):
    """Files are read in byte ranges of 200 bytes, each a task of its own."""
    changed = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "200",
               "spark.sql.files.minPartitionNum": "1000"}
    old = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def some_rows(seed, n=300):
    r = random.Random(seed)
    parts = ['"', '""', ",", "\n", "a", "b c", "\n\n", "", "12\" pipe", "é", "x" * 30]
    return [[str(i), *("".join(r.choices(parts, k=r.randrange(5))) for _ in range(3))] for i in range(n)]


def as_text(rows, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=quoting).writerows([["id", "a", "b", "c"], *rows])
    return out.getvalue()


def line_ends():
    """The end of a line after either beginning, against a reader of single characters."""

    def walk(line, inside):
        at_start, i = not inside, 0
        while i < len(line):
            if inside:
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        inside = False
                at_start = False
            else:
                inside = at_start and line[i] == '"'
                at_start = line[i] == ","
            i += 1
        return inside

    r = random.Random(5)
    lines = ["".join(r.choices(['"', '""', ",", "a", " "], k=r.randrange(9))) for _ in range(3000)]
    return lines, [(walk(x, False), walk(x, True)) for x in lines]


def test_patterns(spark):
    lines, want = line_ends()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = df.select("i", csv_records.opens(), F.col("line").rlike(csv_records.STAYS_INSIDE)).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == want


def test_states():
    r = np.random.default_rng(1)
    table = {0: (0, 0), 1: (1, 0), 2: (0, 1), 3: (1, 1)}
    for n in (0, 1, 2, 17):
        for first in (0, 1):
            codes = r.integers(0, 4, n)
            want = [first]
            for c in codes:
                want.append(table[int(c)][want[-1]])
            assert csv_records.states(codes, first).tolist() == want


@pytest.mark.parametrize("seed", [1, 2])
def test_records_over_many_ranges(spark, tmp_path, small_ranges, seed):
    rows = some_rows(seed)
    path = write(tmp_path / "r.csv", as_text(rows))
    raw = ci.read_csv_raw(spark, path)
    assert csv_records.read_lines(spark, path).rdd.getNumPartitions() > 20
    got = sorted((list(r) for r in raw.collect()), key=lambda x: int(x[0]))
    assert got == [[c if c not in ci.MISSING_TEXTS else None for c in row] for row in rows]
    theirs = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    # the reader that keeps a file in one task gives the same cells
    same = sorted((list(r) for r in theirs.na.fill("").collect()), key=lambda x: int(x[0]))
    assert [[c or "" for c in row] for row in got] == same


def test_a_cell_over_several_ranges(spark, tmp_path, small_ranges):
    cells = ["\n".join(f"line {i} \"\"of\"\" {n}" for i in range(n)) for n in (1, 60, 2, 300)]
    path = write(tmp_path / "l.csv", "id,a\n" + "".join(f'{i},"{c}"\n' for i, c in enumerate(cells)))
    got = sorted(map(tuple, ci.read_csv_raw(spark, path).collect()))
    assert got == [(str(i), c.replace('""', '"')) for i, c in enumerate(cells)]


def test_header_over_lines_and_several_files(spark, tmp_path, small_ranges):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for i in range(3):
        write(folder / f"p{i}.csv", '\nid,"a\nname"\n' + "".join(f'{i}{j},"x\n{j}"\n\n' for j in range(30)))
    raw = ci.read_csv_raw(spark, str(folder))
    assert raw.columns == ["id", "a_name"]
    assert sorted(map(tuple, raw.collect())) == sorted((f"{i}{j}", f"x\n{j}") for i in range(3) for j in range(30))


def test_a_row_that_equals_the_header(spark, tmp_path):
    raw = ci.read_csv_raw(spark, write(tmp_path / "h.csv", "a,b\n1,2\na,b\n3,4\n"))
    assert sorted(map(tuple, raw.collect())) == [("1", "2"), ("3", "4"), ("a", "b")]


def test_bare_quotes(spark, tmp_path):
    body = 'id,name\n1,12" pipe\n2,5" x 7" board\n3,"said ""no"""\n4,a"b,\n'.replace('a"b,', 'a"b')
    raw = ci.read_csv_raw(spark, write(tmp_path / "b.csv", body))
    assert sorted(map(tuple, raw.collect())) == [("1", '12" pipe'), ("2", '5" x 7" board'), ("3", 'said "no"'), ("4", 'a"b')]


def test_long_cells(spark, tmp_path):
    """A short row with a cell of a megabyte, one of many quotes, and many cells: no pattern recurses."""
    long, quotes = "y" * 1_000_000, '""' * 300_000
    path = write(tmp_path / "l.csv", f'a,b,c\n1,"{long}"\n2,"{quotes}",z\n')
    assert sorted((r.a, len(r.b), r.c) for r in ci.read_csv_raw(spark, path).collect()) == [
        ("1", 1_000_000, None), ("2", 300_000, "z"),
    ]
    wide = ",".join(f"c{i}" for i in range(3000))
    path = write(tmp_path / "w.csv", f"{wide}\n" + ",".join('"q"' for _ in range(2999)) + "\n")
    with pytest.raises(ci.MalformedFile, match="1 rows have more"):
        ci.read_csv_raw(spark, write(tmp_path / "m.csv", "a,b\n" + ",".join('"q"' for _ in range(20_000)) + "\n"))


def bytes_read(spark):
    files = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in files if s.getScheme() == "file")


def test_two_scans(spark, tmp_path):
    """Types, refusals, rows and lost cells take two scans; the target is not read."""
    body = "".join(f'{i},"name, {i}",{i / 8},{"?" if i % 1000 == 0 else i}\n' for i in range(200_000))
    path, target = write(tmp_path / "s.csv", "id,name,part,odd\n" + body), str(tmp_path / "s")
    size = os.path.getsize(path)
    before = bytes_read(spark)
    rules, rows = ci._load(spark, path, target, False)
    assert bytes_read(spark) - before < 2.2 * size
    assert rows == 200_000 and {r.name: r.lost for r in rules} == {"id": 0, "name": 0, "part": 0, "odd": 200}
    assert [r.lost for r in ci.measure_lost(spark.read.parquet(target), rules_before(rules))] == [r.lost for r in rules]


def rules_before(rules):
    return [type(r)(r.name, r.kind, r.type, r.max_length, r.known) for r in rules]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_failing_write_leaves_the_old_table(spark, tmp_path, kind):
    target = str(tmp_path / "t" / "kept") if kind == "path" else "kept_table"
    spark.sql("DROP TABLE IF EXISTS kept_table")
    good = spark.range(10).withColumn("v", F.lit("old"))
    tables.write_table(good, target)
    bad = spark.range(1000).withColumn("v", F.when(F.col("id") == 777, F.raise_error(F.lit("half way"))).otherwise("new"))
    with pytest.raises(Exception, match="half way"):
        tables.write_table(bad, target)
    assert {r.v for r in tables.read_target(spark, target).collect()} == {"old"}
    # a target may be rewritten from its own rows
    tables.write_table(tables.read_target(spark, target).where("id < 4"), target)
    assert tables.read_target(spark, target).count() == 4
    if kind == "path":
        assert os.listdir(tmp_path / "t") == ["kept"]
    else:
        assert [t.name for t in spark.catalog.listTables() if "kept_table" in t.name] == ["kept_table"]
        spark.sql("DROP TABLE kept_table")


def test_one_bad_file_never_ends_the_others(spark, tmp_path):
    write(tmp_path / "short.csv", 'a,b,c\n1,"' + "y" * 1_000_000 + '"\n')
    write(tmp_path / "more.csv", "a,b\n1,2,3\n")
    write(tmp_path / "good.csv", "a,b\n1,2\n2,x\n")
    (tmp_path / "zip.csv.gz").write_bytes(b"no archive")
    files = {"zip.csv.gz": "zip", "short.csv": "short", "more.csv": "more", "none.csv": "none", "good.csv": "good"}
    out = tmp_path / "out"
    tables.write_table(spark.range(3), str(out / "more"))
    for at_once in (1, 5):
        report = ci.import_tables(spark, str(tmp_path), str(out), files, at_once=at_once).collect()
        assert [(r.table, r.status, r.rows) for r in report] == [
            ("zip", "error", None), ("short", "loaded", 1), ("more", "error", None), ("none", "skipped", None), ("good", "loaded", 2),
        ]
    assert spark.read.parquet(str(out / "more")).count() == 3


def test_scopes_of_threads_stay_apart(spark):
    seen, go = {}, threading.Barrier(2)

    def work(name):
        with scratch_scope(spark) as folder:
            go.wait(20)
            spark.range(3).write.parquet(f"{folder}/{name}")
            go.wait(60)
            if name == "b":
                time.sleep(1)  # the other scope has ended by now
            seen[name] = folder, spark.read.parquet(f"{folder}/{name}").count()

    threads = [threading.Thread(target=work, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen["a"][0] != seen["b"][0] and seen["a"][1] == seen["b"][1] == 3
    assert all(os.path.dirname(f) == shared_dir(spark) for f, _ in seen.values())
