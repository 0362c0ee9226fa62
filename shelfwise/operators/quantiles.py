"""Exact quantiles of many columns at once, from a mergeable sketch.

A first pass makes a KLL sketch of each column, one small buffer for a task and
group. The sketch brackets each wanted rank between two values. A second pass
counts the rows between brackets and, one by one, the values inside them: a small
share of all. Buckets of those counts give first ranks, and only buckets that hold
a wanted rank are put in order. No value is sorted, written or shuffled otherwise.

A sketch is random, so brackets are fixed before they are used: building the plan
runs the first pass, and a task that runs again sees the same brackets. That one
misses its rank has a probability of about 1e-14, is noticed by the counts, and
raises an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.joins import salted_join
from shelfwise.session import materialize

#: Size of a sketch. A rank is wrong by more than ERROR (a share of all rows) in one of 100 cases.
SKETCH = 4096
ERROR = 2.296 / SKETCH**0.9723
#: Half a bracket, in shares of all rows: three times that error, 7.7 standard deviations, and two
#: ranks of the smallest input that has brackets. Up to SKETCH rows the bracket is the whole range.
REACH = 3 * ERROR + 2 / SKETCH
#: Buckets of equal width in a bracket.
BUCKETS = 1024

_MISSED = "a sketch missed a rank; run the query again"


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, value) of the known numbers in ``cols``."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    for key in by:
        wide = wide.where(F.col(key).isNotNull())
    long = wide.unpivot(list(by), list(cols), "column", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, value, rows): how often each value occurs."""
    return long_values(df, cols, by).groupBy(*by, "column", "value").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _position(p: float) -> str:
    return f"((n - 1) * {float(p)!r}D)"


def _holds(rank: str) -> str:
    return f"(first_rank <= {rank} AND {rank} < next_rank)"


def _brackets(
    df: DataFrame, cols: Sequence[str], ps: Sequence[float], by: Sequence[str], extra: Mapping[str, str]
) -> DataFrame:
    """Rows (by..., column, n, extra..., low0, high0, low1, ...): the values between which each rank lies.

    One aggregate in which each task has one sketch for each column and group.
    ``extra`` are aggregates of ``value`` taken in the same pass.
    """
    cells = {"n": "count(1)", "least": "min(value)", "most": "max(value)",
             "sketch": f"kll_sketch_agg_double(value, {SKETCH})", **extra}
    long = long_values(df, cols, by).groupBy(*by, "column").agg(*[F.expr(f"{sql} AS `{name}`") for name, sql in cells.items()])
    ends = []
    for i, p in enumerate(ps):
        at = f"WHEN n > {SKETCH} THEN kll_sketch_get_quantile_double(sketch, {{!r}}D)"
        low, high = at.format(float(p) - REACH), at.format(float(p) + REACH)
        ends.append(f"CASE {low if p > REACH else 'WHEN false THEN 0D'} ELSE least END AS low{i}")
        ends.append(f"CASE {high if p < 1 - REACH else 'WHEN false THEN 0D'} ELSE most END AS high{i}")
    return long.selectExpr(*by, "column", "n", *extra, *ends)


def _fixed(marks: DataFrame, by: Sequence[str]) -> DataFrame:
    """The brackets of one run: a row for each column goes through the driver, those of groups are written."""
    return materialize(marks, "brackets") if by else marks.sparkSession.createDataFrame(marks.collect(), marks.schema)


def _bucket(low: str, high: str) -> str:
    """Order-preserving bucket of a value between two ends; one bucket where the width is none or no number."""
    width = f"({high} - {low})"
    return (
        f"CASE WHEN {width} > 0 AND {width} < double('infinity') "
        f"THEN least({BUCKETS - 1}, CAST(floor((value - {low}) / {width} * {BUCKETS}) AS INT)) ELSE 0 END"
    )


def _cells(long: DataFrame, marks: DataFrame, keys: list[str], ps: Sequence[float], extra: Sequence[str]) -> DataFrame:
    """Rows (keys..., zone, bucket, value, rows, n, extra...) in the order (zone, bucket, value).

    Zone z begins at the lower end of bracket z - 1. Values of the bracket are
    counted one by one; those after it, up to the next, are one row without value.
    """
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    zone = " ".join(f"WHEN value < low{i} THEN {z}" for z, i in enumerate(order))
    inside = " ".join(f"WHEN zone = {z} AND value <= high{i} THEN {{{i}}}" for z, i in enumerate(order, start=1))
    values = inside.format(*["value"] * len(ps))
    buckets = inside.format(*[_bucket(f"low{i}", f"high{i}") for i in range(len(ps))])
    # Without groups there is one row per column; the number of groups has no bound.
    if len(keys) > 1:
        placed = salted_join(long, marks, keys, ["value"], "inner")
    else:
        placed = long.join(F.broadcast(marks), keys)
    placed = placed.withColumn("zone", F.expr(f"CASE {zone} ELSE {len(ps)} END"))
    placed = placed.selectExpr(
        *keys, "zone", f"coalesce(CASE {buckets} ELSE {BUCKETS} END, 0) AS bucket", f"CASE {values} END AS value", "n", *extra
    )
    kept = [F.max(c).alias(c) for c in ("n", *extra)]
    return placed.groupBy(*keys, "zone", "bucket", "value").agg(F.count(F.lit(1)).alias("rows"), *kept)


def _interpolated(p: float) -> str:
    """Linear interpolation from the nearer end, so both ends are hit exactly."""
    position = _position(p)
    low = f"max(CASE WHEN {_holds(f'floor({position})')} THEN coalesce(value, raise_error('{_MISSED}')) END)"
    high = f"max(CASE WHEN {_holds(f'ceil({position})')} THEN coalesce(value, raise_error('{_MISSED}')) END)"
    part = f"max({position} - floor({position}))"
    return (
        f"CASE WHEN {low} = {high} THEN {low} WHEN {part} < 0.5D THEN {low} + ({high} - {low}) * {part} "
        f"ELSE {high} - ({high} - {low}) * (1 - {part}) END"
    )


def _selected(
    cells: DataFrame, keys: list[str], ps: Sequence[float], names: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Rows (keys..., n, extra..., names...) from cells; only buckets that hold a wanted rank are put in order."""
    # Both uses of the cells read the same columns, so that they share one shuffle.
    kept = [F.max(c).alias(c) for c in ("n", *extra)]
    sizes = cells.groupBy(*keys, "zone", "bucket").agg(F.sum("rows").alias("rows"), *kept)
    # At most BUCKETS + 1 rows for each bracket of a key go through this count.
    up_to = Window.partitionBy(*keys).orderBy("zone", "bucket")
    ranked = sizes.withColumn("next_rank", F.sum("rows").over(up_to)).selectExpr("*", "next_rank - rows AS first_rank")
    wanted = [_holds(f"{end}({_position(p)})") for p in ps for end in ("floor", "ceil")]
    needed = ranked.where(" OR ".join(wanted)).selectExpr(
        *keys, "zone", "bucket", "first_rank AS before", *(f"`{c}` AS `_{c}`" for c in extra)
    )
    within = Window.partitionBy(*keys, "zone", "bucket").orderBy("value")
    found = (
        cells.join(needed, [*keys, "zone", "bucket"])
        .withColumn("next_rank", F.col("before") + F.sum("rows").over(within))
        .selectExpr("*", "next_rank - rows AS first_rank")
    )
    results = [F.expr(f"{_interpolated(p)} AS {name}") for p, name in zip(ps, names, strict=True)]
    more = [F.max(F.coalesce(c, f"_{c}")).alias(c) for c in extra]
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *more, *results)


def quantiles_of_counts(
    counts: DataFrame,
    ps: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Quantiles of value counts: one row (by..., column, n, names...) per column.

    One bracket from the least to the largest value, so no sketch is needed.
    """
    keys = [*by, "column"]
    ends = counts.groupBy(*keys).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("rows").alias("n"))
    if by:  # the number of groups has no bound
        placed = salted_join(counts, ends, keys, ["value"], "inner")
    else:
        placed = counts.join(F.broadcast(ends), keys)
    cells = placed.selectExpr(*keys, "0 AS zone", f"{_bucket('low', 'high')} AS bucket", "value", "rows", "n")
    return _selected(cells, keys, ps, names)


def quantile_columns(
    df: DataFrame,
    cols: Sequence[str],
    ps: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
    exact: bool = True,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation: one row (by..., column, n, extra..., names...) per column.

    Nulls and NaN are left out; a column without values has no row. ``extra``
    names SQL aggregates of ``value`` that the first pass takes along.
    ``exact=False`` gives values from the data out of the sketch alone: one pass.
    """
    extra = dict(extra or {})
    if not exact:
        at = [F.percentile_approx("value", float(p), 10000).alias(n) for p, n in zip(ps, names, strict=True)]
        more = [F.expr(sql).alias(name) for name, sql in extra.items()]
        return long_values(df, cols, by).groupBy(*by, "column").agg(F.count(F.lit(1)).alias("n"), *more, *at)
    keys = [*by, "column"]
    marks = _fixed(_brackets(df, cols, ps, by, extra), by)
    cells = _cells(long_values(df, cols, by), marks, keys, ps, list(extra))
    return _selected(cells, keys, ps, names, list(extra))


def quantiles(
    df: DataFrame, cols: Sequence[str], ps: Sequence[float], by: Sequence[str] = (), exact: bool = True
) -> DataFrame:
    """Quantiles in long form, rows (by..., column, n, p, quantile)."""
    names = [f"q{i}" for i in range(len(ps))]
    wide = quantile_columns(df, cols, ps, names, by, exact)
    pairs = ", ".join(f"{float(p)!r}D, {name}" for p, name in zip(ps, names, strict=True))
    stack = F.expr(f"stack({len(ps)}, {pairs}) AS (p, quantile)")
    return wide.select(*by, "column", "n", stack)
