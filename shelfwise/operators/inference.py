"""Correlation matrix, confidence intervals and Welch's t-test."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.student_t import t_critical, t_two_sided_p
from shelfwise.operators.quantiles import quantile_columns

TOP, LOW = "top", "low"


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs, rows (a, b, r).

    Each pair uses the rows where both values are known; a pair without spread, or
    without common rows, has a null correlation. A task keeps one buffer with the
    counts, means and co-moments of all pairs and gives one row for each pair; rows
    of tasks are merged around their common mean, so that a large offset of the
    values costs no digits.
    """
    null = F.lit(None).cast("double")
    values = df.select(*[F.nanvl(F.col(c).cast("double"), null).alias(f"v{i}") for i, c in enumerate(cols)])
    shape = "i int, j int, n bigint, mx double, my double, ox double, oy double, xx double, yy double, xy double"
    pair = Window.partitionBy("i", "j")
    # A mean is one of the values and an offset, so that differences of means keep their digits.
    parts = values.mapInArrow(_co_moments, shape).withColumns({
        "dx": F.col("mx") - F.min("mx").over(pair) + F.col("ox"),
        "dy": F.col("my") - F.min("my").over(pair) + F.col("oy"),
        "all": F.sum("n").over(pair),
    })
    parts = parts.withColumns(
        {d: F.col(d) - F.sum(F.col("n") * F.col(d)).over(pair) / F.col("all") for d in ("dx", "dy")}
    )
    moments = parts.groupBy("i", "j").agg(
        F.sum(F.col("xx") + F.col("n") * F.col("dx") * F.col("dx")).alias("xx"),
        F.sum(F.col("yy") + F.col("n") * F.col("dy") * F.col("dy")).alias("yy"),
        F.sum(F.col("xy") + F.col("n") * F.col("dx") * F.col("dy")).alias("xy"),
    )
    spread = (F.col("xx") > 0) & (F.col("yy") > 0)
    ratio = F.col("xy") / (F.sqrt("xx") * F.sqrt("yy"))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio))
    r = F.when(spread, F.when(F.col("i") == F.col("j"), 1.0).otherwise(bounded))
    # Every pair appears even where no row has both values.
    grid = [(a, b, min(p, q), max(p, q)) for p, a in enumerate(cols) for q, b in enumerate(cols)]
    upper = df.sparkSession.createDataFrame(grid, "a string, b string, i int, j int")
    return upper.join(moments.select("i", "j", r.alias("r")), ["i", "j"], "left").select("a", "b", "r")


def _centred(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Columns less the mean of their known values, 0 elsewhere; a value and the mean's offset from it; the sums of squares.

    Equal values give an offset and a sum of exactly 0.
    """
    if not len(x):
        return x, *np.zeros((3, x.shape[1]))
    first = np.where(known.any(0), x[known.argmax(0), np.arange(x.shape[1])], 0.0)
    shifted = np.where(known, x - first, 0.0)
    middle = shifted.sum(0) / np.maximum(known.sum(0), 1)
    centred = np.where(known, shifted - middle, 0.0)
    return centred, first, middle, (centred * centred).sum(0)


def _co_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each pair of columns with common rows in this task.

    Matrices hold in cell (i, j) what concerns column i over the rows where j is
    known too; batches are merged by Chan's update.
    """
    total = None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
        known = ~np.isnan(x)
        with np.errstate(all="ignore"):
            n = known.T.astype(np.float64) @ known
            centred, *found = _centred(x, known)
            first, offset, own = (np.repeat(v[:, None], len(v), axis=1) for v in found)
            both = centred.T @ centred
            for j in np.flatnonzero(~known.all(0)):
                rows = known[:, j]
                part, first[:, j], offset[:, j], own[:, j] = _centred(x[rows], known[rows])
                both[:, j] = part.T @ centred[rows, j]
            if total is None:
                total = [n, first, offset, own, both]
                continue
            n1, first1, offset1, own1, both1 = total
            every = np.maximum(n1 + n, 1)
            d = np.where((n1 > 0) & (n > 0), first - first1 + (offset - offset1), 0.0)
            weight = n1 * n / every
            offset = np.where(n1 > 0, offset1 + d * (n / every), offset)
            total = [n1 + n, np.where(n1 > 0, first1, first), offset, own1 + own + d * d * weight, both1 + both + d * d.T * weight]
    if total is not None:
        n, first, offset, own, both = total
        i, j = np.nonzero(np.triu(n) > 0)
        columns = (i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), first[i, j], first[j, i],
                   offset[i, j], offset[j, i], own[i, j], own[j, i], both[i, j])
        names = ["i", "j", "n", "mx", "my", "ox", "oy", "xx", "yy", "xy"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def mean_ci(
    df: DataFrame, column: str, by: Sequence[str] = (), confidence: float = 0.95
) -> DataFrame:
    """Mean with a two-sided t interval, per group if asked."""
    known = df.where(F.col(column).isNotNull() & ~F.isnan(column))
    stats = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("sd"),
    )
    # The t factor is computed on the few aggregated rows.
    margin = t_critical(confidence, F.col("n") - 1) * F.col("sd") / F.sqrt(F.col("n").cast("double"))
    return stats.withColumn("margin", margin).select(
        *by,
        "n",
        "mean",
        (F.col("mean") - F.col("margin")).alias("lower"),
        (F.col("mean") + F.col("margin")).alias("upper"),
    )


def cohorts(
    df: DataFrame,
    measure: str = "TotalSalesDollars",
    column: str = "ProfitMargin",
    low_rule: str = "ge",
    share: float = 0.25,
) -> DataFrame:
    """Rows (cohort, value): top and low sellers; a row may be in both (see ``ci_top_low``)."""
    if low_rule not in ("ge", "le"):
        raise ValueError("low_rule is 'ge' or 'le'")
    edges = quantile_columns(df, [measure], (share, 1 - share), ("low", "high"))
    edge = edges.select(F.struct("low", "high").alias("edges")).scalar()
    value = F.col(measure)
    in_low: Column = value >= edge["low"] if low_rule == "ge" else value <= edge["low"]
    groups = F.array_compact(
        F.array(F.when(value >= edge["high"], F.lit(TOP)), F.when(in_low, F.lit(LOW)))
    )
    return df.select(F.explode(groups).alias("cohort"), F.col(column).alias("value")).where(
        "value IS NOT NULL"
    )


def ci_top_low(
    df: DataFrame,
    measure: str = "TotalSalesDollars",
    column: str = "ProfitMargin",
    low_rule: str = "ge",
    share: float = 0.25,
    confidence: float = 0.95,
) -> DataFrame:
    """Confidence intervals of ``column`` for top and low rows by ``measure``.

    Top rows reach the upper quartile. With ``low_rule="ge"`` the low rows are
    all at or above the lower quartile, which overlaps the top; ``"le"`` takes
    those at or below it.
    """
    return mean_ci(cohorts(df, measure, column, low_rule, share), "value", ["cohort"], confidence)


def welch_test(
    df: DataFrame,
    measure: str = "TotalSalesDollars",
    column: str = "ProfitMargin",
    share: float = 0.25,
    alpha: float = 0.05,
) -> DataFrame:
    """Two-sided unequal-variance t-test between top and low rows, one row."""
    both = cohorts(df, measure, column, "le", share)
    return welch_of_groups(both, "cohort", TOP, LOW, "value", alpha)


def welch_of_groups(
    df: DataFrame, group: str, first: str, second: str, column: str, alpha: float = 0.05
) -> DataFrame:
    """Welch's test between two values of ``group``: t, df, p and the verdict."""

    def moments(name: str, tag: str) -> list[Column]:
        value = F.when(F.col(group) == name, F.col(column))
        return [
            F.count(value).alias(f"n_{tag}"),
            F.avg(value).alias(f"mean_{tag}"),
            F.var_samp(value).alias(f"var_{tag}"),
        ]

    row = df.agg(*moments(first, "a"), *moments(second, "b"))
    row = row.withColumns(
        {
            "ea": F.when(F.col("n_a") > 1, F.col("var_a") / F.col("n_a")),
            "eb": F.when(F.col("n_b") > 1, F.col("var_b") / F.col("n_b")),
        }
    )
    error = F.col("ea") + F.col("eb")
    weight = F.col("ea") * F.col("ea") / (F.col("n_a") - 1) + F.col("eb") * F.col("eb") / (F.col("n_b") - 1)
    row = row.withColumns(
        {
            "t": F.when(error > 0, (F.col("mean_a") - F.col("mean_b")) / F.sqrt(error)),
            "df": F.when(error > 0, error * error / weight),
        }
    ).withColumn("p", t_two_sided_p(F.col("t"), F.col("df")))
    return row.select(
        "n_a", "mean_a", "n_b", "mean_b", "t", "df", "p", (F.col("p") < alpha).alias("reject")
    )
