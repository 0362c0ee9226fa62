import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators.distributions import box_stats, histogram, kde
from shelfwise.operators.inference import (
    ci_top_low,
    correlation_matrix,
    mean_ci,
    welch_of_groups,
    welch_test,
)
from shelfwise.operators.profile import describe
from shelfwise.operators.quantiles import (
    REACH,
    _brackets,
    _cells,
    _selected,
    long_values,
    quantile_columns,
    quantiles,
    quantiles_of_counts,
    value_counts_long,
)
from shelfwise.session import materialize

PS = (0.0, 0.15, 0.25, 1 / 3, 0.5, 2 / 3, 0.85, 1.0)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    a = rng.lognormal(3, 2, 3000).round(2)
    return pd.DataFrame({
        "g": rng.choice(["x", "y", "z"], 3000, p=[0.9, 0.08, 0.02]),
        "a": a,
        "b": np.where(rng.random(3000) < 0.4, 5.0, rng.integers(0, 9, 3000)),  # one hot value
        "c": np.where(rng.random(3000) < 0.1, np.nan, a * 2 + rng.normal(0, 50, 3000)),
        "k": 4.0,
    })


@pytest.fixture(scope="module")
def df(spark, sample):
    return spark.createDataFrame(sample.astype(object).where(sample.notna(), None).values.tolist(),
                                 "g string, a double, b double, c double, k double")


def as_dict(rows, names):
    return {r["column"]: [r[n] for n in names] for r in rows}


def test_quantiles_equal_numpy(spark, df, sample):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names = [f"q{i}" for i in range(len(PS))]
        counts = materialize(value_counts_long(df, ["a", "b", "c", "k"]), "values")
        found = quantiles_of_counts(counts, PS, names).collect()
        got = as_dict(found, names)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for col in "abck":
        assert got[col] == pytest.approx(sample[col].quantile(list(PS)).tolist(), rel=1e-12)


def test_grouped_quantiles(df, sample):
    counts = materialize(value_counts_long(df, ["a"], ["g"]), "values")
    got = quantiles_of_counts(counts, (0.5, 0.9), ("m", "n9"), ["g"]).collect()
    want = sample.groupby("g").a.quantile([0.5, 0.9]).unstack()
    assert {r.g: (r.m, r.n9) for r in got} == {
        g: pytest.approx((want.loc[g, 0.5], want.loc[g, 0.9])) for g in "xyz"
    }


def test_quantile_forms(df, sample):
    long = quantiles(df, ["a"], (0.25, 0.75)).orderBy("p").collect()
    assert [(r.p, r.n) for r in long] == [(0.25, 3000), (0.75, 3000)]
    rough = quantile_columns(df, ["a"], (0.5,), ("m",), exact=False).first()
    assert abs((sample.a <= rough.m).mean() - 0.5) < 0.01


def scans(df):
    """Scans of files in the plan that ran, those of reused exchanges left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan parquet")


def test_brackets_of_large_columns(spark, tmp_path):
    """More rows than a sketch keeps: heavy ties, sorted input, wide ranges, infinities; two scans and no sort of all."""
    rows = spark.range(0, 300_000, 1, 6).selectExpr(
        "CAST(id % 3 AS STRING) AS g",
        "CAST(id AS DOUBLE) AS up",
        "CAST(-id AS DOUBLE) AS down",
        "CASE WHEN id % 10 < 4 THEN 7D ELSE CAST(hash(id) AS DOUBLE) END AS ties",
        "pow(10D, (hash(id, 1) % 300)) AS wide",
        "CASE WHEN id % 5 = 0 THEN double('infinity') WHEN id % 7 = 0 THEN null ELSE CAST(id % 1000 AS DOUBLE) END AS ends",
        "CASE WHEN id % 2 = 0 THEN id ELSE 300000 - id END % 4099 * 1D AS zigzag",
    )
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    cols = ["up", "down", "ties", "wide", "ends", "zigzag"]
    ps = (0.0, 0.0001, 0.3, 0.4, 0.5, 0.9999, 1.0)
    names = [f"q{i}" for i in range(len(ps))]
    found = quantile_columns(df, cols, ps, names)
    got, frame = as_dict(found.collect(), names), df.toPandas()
    for c in cols:
        want = np.sort(frame[c].dropna().to_numpy())
        for p, value in zip(ps, got[c], strict=True):
            at = (len(want) - 1) * p
            low, high = want[int(np.floor(at))], want[int(np.ceil(at))]
            assert value == (low if low == high else pytest.approx(low + (high - low) * (at - np.floor(at)), rel=1e-12)), (c, p)
    assert scans(found) == 1  # the other was run for the brackets
    grouped = quantile_columns(df, ["ties"], (0.2, 0.5), ("a", "b"), ["g"]).collect()
    want = frame.groupby("g").ties.quantile([0.2, 0.5]).unstack()
    assert {r.g: [r.a, r.b] for r in grouped} == {g: pytest.approx(want.loc[g].tolist()) for g in "012"}


def test_few_values_are_counted_one_by_one(spark):
    """Only a small share of the values leaves the tasks."""
    df = spark.range(0, 400_000, 1, 8).selectExpr("CAST(hash(id) AS DOUBLE) AS a")
    ps, names = (0.25, 0.5, 0.75), ("x", "y", "z")
    marks = _brackets(df, ["a"], ps, [], {})
    cells = _cells(long_values(df, ["a"]), marks, ["column"], ps, [])
    assert cells.count() < 400_000 * 3 * 2.5 * REACH


def test_description_reads_its_rows_twice(spark, tmp_path):
    spark.range(0, 50_000, 1, 4).selectExpr("CAST(hash(id) AS DOUBLE) AS a", "id AS b").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    found = describe(df)
    assert scans(found) == 1  # and once for brackets and moments
    frame = df.toPandas()
    for r in found.collect():
        v = frame[r["column"]]
        want = [len(v), v.mean(), v.std(), v.min(), *v.quantile([0.25, 0.5, 0.75]), v.max()]
        assert list(r)[1:] == pytest.approx([float(x) for x in want])


def test_a_missed_rank_is_noticed(spark):
    """Brackets that do not hold their rank raise an error, never a wrong value."""
    df = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS a")
    marks = _brackets(df, ["a"], (0.5,), [], {}).withColumns({"low0": F.lit(3.0), "high0": F.lit(9.0)})
    cells = _cells(long_values(df, ["a"]), marks, ["column"], (0.5,), [])
    with pytest.raises(Exception, match="missed a rank"):
        _selected(cells, ["column"], (0.5,), ("m",)).collect()


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(3.5,)], "a double")
    assert quantile_columns(one, ["a"], (0.0, 0.4, 1.0), "xyz").first()[2:] == (3.5, 3.5, 3.5)
    assert quantile_columns(one.where("a < 0"), ["a"], (0.5,), "x").count() == 0


def test_histogram_equals_numpy(df, sample):
    rows = histogram(df, ["a", "b", "c", "k"]).toPandas()
    for col, part in rows.groupby("column"):
        counts, edges = np.histogram(sample[col].dropna(), bins=30)
        part = part.sort_values("bin")
        assert part["count"].tolist() == counts.tolist(), col
        assert part["left"].tolist() == pytest.approx(edges[:-1].tolist())
        assert part["right"].tolist() == pytest.approx(edges[1:].tolist())


def test_histogram_puts_edges_in_the_upper_bin(spark):
    values = [i / 10 for i in range(31)]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = histogram(df, ["a"]).orderBy("bin").toPandas()["count"].tolist()
    assert got == np.histogram(values, bins=30)[0].tolist()


def test_grouped_histogram_and_density(df, sample):
    bins = histogram(df, ["a"], by=["g"]).toPandas()
    curves = kde(df, ["a"], by=["g"]).toPandas()
    for g, part in sample.groupby("g"):
        v = part.a.to_numpy()
        counts, edges = np.histogram(v, bins=30)
        mine = bins[bins.g == g].sort_values("bin")
        assert mine["count"].tolist() == counts.tolist()
        assert mine["left"].tolist() == pytest.approx(edges[:-1].tolist())
        width = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min(), v.max(), 200)
        y = np.exp(-(((x[:, None] - v) / width) ** 2) / 2).sum(1) / width / np.sqrt(2 * np.pi) * (v.max() - v.min()) / 30
        curve = curves[curves.g == g].sort_values("point")
        assert curve.x.tolist() == pytest.approx(x.tolist()) and curve.y.tolist() == pytest.approx(y.tolist())


def test_density_curve(df, sample):
    rows = kde(df, ["b", "c", "k"]).toPandas()
    assert set(rows.column) == {"b", "c"}  # no curve without spread
    for col in "bc":
        v = sample[col].dropna().to_numpy()
        width = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min(), v.max(), 200)
        y = np.exp(-(((x[:, None] - v) / width) ** 2) / 2).sum(1) / width / np.sqrt(2 * np.pi)
        part = rows[rows.column == col].sort_values("point")
        assert part.x.tolist() == pytest.approx(x.tolist())
        assert part.y.tolist() == pytest.approx((y * (v.max() - v.min()) / 30).tolist())


def test_density_of_wide_ranges(spark):
    """Outliers far beyond the bandwidth, ties and a large offset; no Python in the plan; boxes, not values, are evaluated."""
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({
        "a": np.concatenate([rng.normal(size=4000), [900.0, 901.0, -350.0]]),
        "b": np.concatenate([np.repeat(1e6, 2000), rng.normal(1e6, 3, 2003)]),
        "c": rng.lognormal(0, 3, 4003),
    })
    df = spark.createDataFrame(frame.values.tolist(), "a double, b double, c double").repartition(5)
    found = kde(df, ["a", "b", "c"])
    assert not re.search("Python|MapInArrow|MapInPandas", found._jdf.queryExecution().executedPlan().toString())
    rows = found.toPandas()
    assert len(rows) == 600
    for col in "abc":
        v = frame[col].to_numpy()
        width = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min(), v.max(), 200)
        y = np.exp(-(((x[:, None] - v) / width) ** 2) / 2).sum(1) / width / np.sqrt(2 * np.pi) * (v.max() - v.min()) / 30
        part = rows[rows.column == col].sort_values("point")
        assert part.x.tolist() == pytest.approx(x.tolist())
        assert part.y.tolist() == pytest.approx(y.tolist(), rel=1e-8, abs=1e-8)


def box(v):
    q1, med, q3 = np.percentile(v, [25, 50, 75])
    inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
    low, high = min(inside.min(), q1), max(inside.max(), q3)
    return [len(v), q1, med, q3, low, high, int(((v < low) | (v > high)).sum())]


def test_box_statistics(df, sample):
    names = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]
    got = as_dict(box_stats(df, ["a", "b", "c", "k"]).collect(), names)
    for col in "abck":
        assert got[col] == pytest.approx(box(sample[col].dropna().to_numpy()))
    grouped = {r.g: [r[n] for n in names] for r in box_stats(df, ["a"], ["g"]).collect()}
    assert grouped == {g: pytest.approx(box(v.to_numpy())) for g, v in sample.groupby("g").a}


def test_correlation_matrix(df, sample):
    rows = correlation_matrix(df, ["a", "b", "c", "k"]).toPandas()
    assert len(rows) == 16
    got = rows.pivot(index="a", columns="b", values="r")
    want = sample[["a", "b", "c", "k"]].corr()
    for x in "abc":
        for y in "abc":
            assert got.loc[x, y] == pytest.approx(want.loc[x, y], abs=1e-12)
    assert got.loc["k"].isna().all() and got["k"].isna().all()  # constant column


def test_correlation_of_large_offsets_and_many_tasks(spark):
    """Values far from 0, nulls in every column, a pair that is constant on its common rows; no row is repeated."""
    rng = np.random.default_rng(5)
    n = 6000
    base = rng.normal(size=n)
    frame = pd.DataFrame({
        "a": base + 1e9,
        "b": 0.5 * base + rng.normal(size=n) + 1e9,
        "c": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n) - 1e7),
        "d": np.where(np.arange(n) % 2 == 0, 0.1, rng.normal(size=n)),
        "e": np.where(np.arange(n) % 2 == 0, base, np.nan),
        "f": 0.1,
    })
    rows = frame.astype(object).where(frame.notna(), None).values.tolist()
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns)).repartition(13)
    found = correlation_matrix(df, list("abcdef"))
    assert not re.search("Generate|Expand", found._jdf.queryExecution().executedPlan().toString())
    got = {(r.a, r.b): r.r for r in found.collect()}
    # the same values without their offsets, exact in binary
    want = (frame - [1e9, 1e9, -1e7, 0, 0, 0]).corr()
    for x in "abc":
        for y in "abc":
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9), (x, y)
    assert got["e", "a"] == pytest.approx(want.loc["e", "a"], abs=1e-9)
    assert got["d", "e"] is None and got["e", "d"] is None and got["f", "f"] is None and got["d", "d"] == 1.0


def test_correlation_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 5.0)], "a double, b double")
    rows = {(r.a, r.b): r.r for r in correlation_matrix(df, ["a", "b"]).collect()}
    assert rows == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}


def test_mean_interval(spark):
    df = spark.createDataFrame([("p", float(v)) for v in range(1, 12)] + [("q", 3.0)], "g string, v double")
    rows = {r.g: r for r in mean_ci(df, "v", ["g"]).collect()}
    half = 2.228139 * np.std(range(1, 12), ddof=1) / np.sqrt(11)
    assert (rows["p"].lower, rows["p"].upper) == pytest.approx((6 - half, 6 + half), abs=1e-5)
    assert rows["q"].mean == 3.0 and rows["q"].lower is None


@pytest.fixture(scope="module")
def margins(spark):
    rows = [(float(i), float((i * 7) % 40)) for i in range(101)]
    return spark.createDataFrame(rows, "TotalSalesDollars double, ProfitMargin double")


def test_low_rule(margins):
    wide = {r.cohort: r.n for r in ci_top_low(margins).collect()}
    assert wide == {"top": 26, "low": 76}  # the low group as written reaches upwards
    assert {r.cohort: r.n for r in ci_top_low(margins, low_rule="le").collect()} == {"top": 26, "low": 26}
    with pytest.raises(ValueError):
        ci_top_low(margins, low_rule="lt")


def test_welch(spark, margins):
    a, b = [5.1, 4.9, 6.2, 5.7, 6.0], [4.1, 5.0, 3.8, 4.4]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v double")
    row = welch_of_groups(df, "g", "a", "b", "v").first()
    ea, eb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 4
    assert row.t == pytest.approx((np.mean(a) - np.mean(b)) / np.sqrt(ea + eb))
    assert row.df == pytest.approx((ea + eb) ** 2 / (ea**2 / 4 + eb**2 / 3))
    # area under the density by brute force
    grid = np.linspace(-abs(row.t), abs(row.t), 200_001)
    density = (1 + grid**2 / row.df) ** (-(row.df + 1) / 2)
    full = np.linspace(-2000, 2000, 4_000_001)
    norm = np.trapezoid((1 + full**2 / row.df) ** (-(row.df + 1) / 2), full)
    assert row.p == pytest.approx(1 - np.trapezoid(density, grid) / norm, abs=1e-6)
    assert row.reject == (row.p < 0.05)
    assert welch_test(margins).first().n_a == 26


def test_welch_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 1.0)], "g string, v double")
    row = welch_of_groups(df, "g", "a", "b", "v").first()
    assert row.t is None and row.p is None and row.reject is None


def test_statistics_skip_missing_and_not_a_number(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "a double")
    assert mean_ci(df, "a").first()["n"] == 2
    assert histogram(df, ["a"]).agg(F.sum("count")).first()[0] == 2
