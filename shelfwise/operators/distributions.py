"""Histogram, density curve and box statistics of numeric columns.

All columns go through one long-form aggregate (column, value); per-column
bounds are one row per column and are the only broadcast side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import salted_join
from shelfwise.operators.quantiles import long_values, quantile_columns


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from minimum to maximum, last bin closed, empty ones kept.

    Rows (by..., column, bin, left, right, count), bins laid for each group. A
    constant column is widened by one half on both sides.
    """
    keys = [*by, "column"]
    long = long_values(df, cols, by)
    flat = F.col("lo") == F.col("hi")
    bounds = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    bounds = bounds.select(
        *keys,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / bins

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * step)

    guess = F.least(
        F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)
    )
    # A value on an edge belongs to the bin that starts there.
    nudge = F.when(F.col("value") < edge(F.col("guess")), -1).when(
        (F.col("value") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), 1
    )
    # Without groups there is one row per column; the number of groups has no bound.
    if by:
        placed = salted_join(long, bounds, keys, ["value"], "inner")
    else:
        placed = long.join(F.broadcast(bounds), keys)
    counts = (
        placed.withColumn("guess", guess)
        .select(*keys, (F.col("guess") + F.coalesce(nudge, F.lit(0))).cast("int").alias("bin"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    frame = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(counts, [*keys, "bin"], "left").select(
        *keys,
        (F.col("bin") + 1).alias("bin"),
        edge(F.col("bin")).alias("left"),
        edge(F.col("bin") + 1).alias("right"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


#: Fast Gauss transform: width of a box in bandwidths, order of its moments, and reach of a box in
#: bandwidths. With half a box r = BOX / 2 a kernel is wrong by at most
#: 1.09 * r ** (ORDER + 1) / sqrt((ORDER + 1)!) = 3e-12 and, beyond the reach, by exp(-REACH ** 2 / 2) = 3e-18.
BOX, ORDER, REACH = 0.5, 11, 9


def _hermite(order: int) -> list[list[int]]:
    """Coefficients of the Hermite polynomials He_0 to He_order, lowest power first."""
    found = [[1], [0, 1]]
    for k in range(1, order):
        last, before = found[-1], found[-2] + [0, 0]
        found.append([a - k * b for a, b in zip([0, *last], before)])
    return found


def kde(df: DataFrame, cols: Sequence[str], grid: int = 200, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Gaussian density on an even grid, scaled to the counts of a histogram.

    Bandwidth is Scott's: sample deviation times n^(-1/5). Rows (by..., column,
    point, x, y). Groups with fewer than two rows or no spread have no curve.

    Values shrink to the moments of boxes half a bandwidth wide, in one aggregate;
    only occupied boxes and the grid points that they reach are evaluated, by the
    Hermite expansion of the kernel around the middle of the box.
    """
    keys = [*by, "column"]
    long = long_values(df, cols, by)
    shape = (
        long.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.stddev_samp("value").alias("sd"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
        .where("n > 1 AND hi > lo")
        .withColumn("width", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    )
    sides = shape.select(*keys, "lo", "hi", "width")
    # Without groups there is one row per column; the number of groups has no bound.
    if by:
        placed = salted_join(long, sides, keys, ["value"], "inner")
    else:
        placed = long.join(F.broadcast(sides), keys)
    placed = placed.withColumn("box", F.floor((F.col("value") - F.col("lo")) / (F.col("width") * BOX)))
    middle = F.col("lo") + (F.col("box") + 0.5) * F.col("width") * BOX
    placed = placed.withColumn("u", (F.col("value") - middle) / F.col("width"))
    powers = ["1D", *("*".join(["u"] * k) for k in range(1, ORDER + 1))]
    # Each box row bears its group's sides, so that no second join is needed.
    moments = [F.expr(f"sum({power})").alias(f"m{k}") for k, power in enumerate(powers)]
    boxes = placed.groupBy(*keys, "box").agg(*[F.max(c).alias(c) for c in ("lo", "hi", "width")], *moments)
    # sum of m[k] / k! * He_k(t) as a polynomial in t
    table = _hermite(ORDER)
    terms = [
        " + ".join(f"{table[k][j] / math.factorial(k)!r}D * m{k}" for k in range(j, ORDER + 1) if table[k][j])
        for j in range(ORDER + 1)
    ]
    step = (F.col("hi") - F.col("lo")) / (grid - 1)
    first = F.greatest(F.lit(0), F.ceil((middle - F.col("lo") - F.col("width") * REACH) / step).cast("int"))
    last = F.least(F.lit(grid - 1), F.floor((middle - F.col("lo") + F.col("width") * REACH) / step).cast("int"))
    near = boxes.select(
        *keys, "lo", "width", middle.alias("middle"), step.alias("step"), first.alias("first"), last.alias("last"),
        *[F.expr(f"({term})").alias(f"a{j}") for j, term in enumerate(terms)],
    ).where("first <= last")
    points = near.withColumn("point", F.explode(F.sequence("first", "last"))).withColumn(
        "t", (F.col("lo") + F.col("point") * F.col("step") - F.col("middle")) / F.col("width")
    )
    polynomial = f"a{ORDER}"
    for j in reversed(range(ORDER)):
        polynomial = f"({polynomial} * t + a{j})"
    kernel = F.expr(f"{polynomial} * exp(-t * t / 2)")
    sums = points.select(*keys, "point", kernel.alias("kernel")).groupBy(*keys, "point").agg(F.sum("kernel").alias("kernel"))
    x = F.col("lo") + F.col("point") * step
    # density * n * bin width, with the 1/n of the density cancelled out
    scale = (F.col("hi") - F.col("lo")) / bins / (F.col("width") * F.sqrt(F.lit(2.0) * F.pi()))
    # a point that no box reaches has no density
    frame = sides.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    return frame.join(sums, [*keys, "point"], "left").select(
        *keys, "point", x.alias("x"), (F.coalesce("kernel", F.lit(0.0)) * scale).alias("y")
    )


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and outlier count.

    One plan of three scans: two for the quartiles, one for what lies inside the fences.
    """
    keys, names = [*by, "column"], ("q1", "median", "q3")
    quartiles = quantile_columns(df, cols, (0.25, 0.5, 0.75), names, by).drop("n")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quartiles.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    # Without groups there is one row per column. With groups their number has
    # no bound and one may hold most values.
    if by:
        fenced = salted_join(long_values(df, cols, by), fences, keys, ["value"], "inner")
    else:
        fenced = long_values(df, cols).join(F.broadcast(fences), keys)
    inside = F.col("value").between(F.col("low"), F.col("high"))
    stats = fenced.groupBy(*keys, *names).agg(
        F.min(F.when(inside, F.col("value"))).alias("first"),
        F.max(F.when(inside, F.col("value"))).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~inside).alias("outliers"),
    )
    # A whisker never ends inside the box.
    return stats.select(
        *keys,
        "n",
        *names,
        F.least("first", "q1").alias("whisker_low"),
        F.greatest("last", "q3").alias("whisker_high"),
        "outliers",
    )
