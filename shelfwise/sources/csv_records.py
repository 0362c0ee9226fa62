"""Records of CSV files, read as lines in many tasks.

A line that begins outside quotes ends outside or inside them, and one that begins
inside ends either way too; both ends follow from the line alone. These functions
of two states are composed over each byte range of a file, the ranges are scanned
in order, and so every range knows whether it begins inside a quoted cell. Then
each task joins its lines to records; only the pieces of records that cross a range
border are shuffled.

A quote opens a cell only as its first character, so ``12" pipe`` is plain text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

# Possessive throughout: nothing is tried twice and nothing recurses, however long a cell is.
_QUOTED = '"(?:[^"]++|"")*+"'
_OPEN = r'"(?:[^"]++|"")*+\z'
_CELLS = f'(?:(?:{_QUOTED}[^,]*+|(?!")[^,]*+),)*+'
#: Lines that begin outside, and inside, of quotes and end inside.
ENDS_INSIDE = rf"\A{_CELLS}{_OPEN}"
STAYS_INSIDE = rf'\A(?:[^"]++|"")*+(?:\z|"[^,]*+,{_CELLS}{_OPEN})'
_WHOLE_CELL = f"(?<![^,]){_QUOTED}"

#: What a line does to the state: 0 ends outside, 1 flips it, 2 keeps it, 3 ends inside.
OUTSIDE, FLIP, KEEP, INSIDE = range(4)
#: A piece that began in an earlier range, a whole record, one that goes on in a later range; the same of the header.
HEAD, RECORD, TAIL, HEADER, HEADER_TAIL = range(5)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, block, line): a hash of the file, the first byte of the range the line is read with."""
    lines = spark.read.text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def opens(line: str = "line") -> Column:
    """Whether a line that begins outside quotes ends inside them."""
    return F.col(line).contains('"') & F.col(line).rlike(ENDS_INSIDE)


def n_cells(record: str) -> Column:
    """Cells of a record: commas outside quoted cells and one."""
    bare = F.regexp_replace(record, _WHOLE_CELL, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _coded(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    code = F.when(~line.contains('"'), KEEP).otherwise(
        line.rlike(ENDS_INSIDE).cast("int") + 2 * line.rlike(STAYS_INSIDE).cast("int")
    )
    return lines.withColumn("code", code.cast("int"))


def states(codes: np.ndarray, first: int) -> np.ndarray:
    """The state before each line and after the last: 1 inside quotes; ``first`` is the state before the first."""
    n = len(codes)
    at = np.arange(1, n + 1)
    fixed = (codes == OUTSIDE) | (codes == INSIDE)
    last = np.concatenate([[0], np.maximum.accumulate(np.where(fixed, at, 0))])
    flips = np.concatenate([[0], np.cumsum(codes == FLIP)])
    base = np.where(last > 0, np.concatenate([[first], codes == INSIDE])[last], first)
    return (base + flips - flips[last]) % 2


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The parts of a batch that belong to one range of one file."""
    file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(file)]):
        yield int(file[a]), int(block[a]), batch.slice(a, b - a)


def _range_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (file, block, outside, inside) for each range: its state at the end after either beginning."""
    held: dict[tuple[int, int], tuple[int, int]] = {}
    for batch in batches:
        if batch.num_rows:
            for file, block, part in _runs(batch):
                codes = part.column(2).to_numpy()
                before = held.get((file, block), (0, 1))
                ends = [int(states(codes, s)[-1]) for s in (0, 1)]
                held[file, block] = (ends[before[0]], ends[before[1]])
    if held:
        rows = [(*key, *value) for key, value in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["file", "block", "outside", "inside"])


def open_ranges(lines: DataFrame) -> DataFrame:
    """Rows (file, block) of the byte ranges that begin inside quotes."""
    shape = "file bigint, block bigint, outside bigint, inside bigint"
    ranges = _coded(lines).select("file", "block", "code").mapInArrow(_range_functions, shape)
    # One row for each byte range of a file goes through this scan.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    flips = ranges.withColumn("flips", F.sum(F.when((F.col("outside") == 1) & (F.col("inside") == 0), 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("block")))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("block", "outside", "flips"))
    seen = flips.withColumns({"last": F.max(fixed).over(before), "done": F.coalesce(F.max("flips").over(before), F.lit(0))})
    state = (F.coalesce("last.outside", F.lit(0)) + F.col("done") - F.coalesce("last.flips", F.lit(0))) % 2
    return seen.where(state == 1).select("file", "block")


def _joined(open_: set[tuple[int, int]]):
    """Lines of a task to records (file, block, place, kind, record), pieces of records at range borders apart."""
    names = ["file", "block", "place", "kind", "record"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, place, kind, headed = None, 0, 0, RECORD, True
        held: list[pa.Array] = []  # lines of the record that is not complete yet

        def out(found: pa.Array, kinds: list[int]) -> pa.RecordBatch:
            nonlocal place, headed
            n = len(found)
            if not headed:
                first = next((i for i, r in enumerate(found) if r.as_py().strip(" ")), None)
                if first is not None:
                    headed = True
                    kinds[first] = HEADER_TAIL if kinds[first] == TAIL else HEADER
            columns = [pa.array([now[0]] * n, pa.int64()), pa.array([now[1]] * n, pa.int64()),
                       pa.array(range(place, place + n), pa.int64()), pa.array(kinds, pa.int32()), found]
            place += n
            return pa.RecordBatch.from_arrays(columns, names)

        def rest(last: int) -> Iterator[pa.RecordBatch]:
            if held:
                yield out(pa.array(["\n".join(x for part in held for x in part.to_pylist())], pa.string()), [last])
                held.clear()

        def end() -> Iterator[pa.RecordBatch]:
            return rest(HEAD if kind == HEAD else TAIL if state else RECORD)

        for batch in batches:
            for file, block, part in _runs(batch) if batch.num_rows else ():
                if (file, block) != now:
                    yield from end()
                    now, place, headed = (file, block), 0, block != 0
                    state = int(now in open_)
                    kind = HEAD if state else RECORD
                lines, codes = part.column(2).cast(pa.string()), part.column(3).to_numpy()
                found = states(codes, state)
                starts = np.flatnonzero(found[:-1] == 0)
                state = int(found[-1])
                if not len(starts):
                    held.append(lines)
                    continue
                if starts[0]:
                    held.append(lines[: starts[0]])
                yield from rest(kind)
                kind = RECORD
                # the last record of a batch may go on in the next one
                whole = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines[: starts[-1]])
                if len(whole):
                    yield out(pc.binary_join(whole, "\n"), [RECORD] * len(whole))
                held.append(lines[starts[-1] :])
        if now:
            yield from end()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (record): the records of all files of a path without the first of each, line breaks as ``\\n``.

    Blank lines between records are left out. A file that ends inside quotes ends
    its last record there. The header must begin in the first byte range.
    """
    lines = read_lines(spark, path)
    # Of the byte ranges (one for 128 MB at the usual settings) those that begin inside quotes.
    open_ = {(r["file"], r["block"]) for r in open_ranges(lines).collect()}
    shape = "file bigint, block bigint, place bigint, kind int, record string"
    found = _coded(lines).select("file", "block", "line", "code").mapInArrow(_joined(open_), shape)
    if open_:  # read for the whole records and for the pieces
        found = materialize(found, "records")
    whole = found.where(F.col("kind") == RECORD).select("record")
    if open_:
        # At most two pieces of each byte range go through this count.
        order = Window.partitionBy("file").orderBy("block", "place")
        begins = F.col("kind").isin(TAIL, HEADER_TAIL)
        pieces = found.where(begins | (F.col("kind") == HEAD)).withColumn("number", F.count_if(begins).over(order))
        parts = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
        joined = pieces.groupBy("file", "number").agg(parts.alias("parts"), F.max("kind").alias("kind"))
        text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")
        whole = whole.unionByName(joined.where(F.col("kind") != HEADER_TAIL).select(text))
    return whole.where(F.length(F.trim("record")) > 0)
