import math
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelfwise.functions.scalars import (
    exact_sum,
    float_div,
    format_dollars,
    plain_number,
    round_half_even,
    safe_div,
    strip_ws,
)
from shelfwise.functions.student_t import critical_value, t_critical, t_two_sided_p, two_sided_p


# What a reader expects to see for each amount.
MONEY = [
    (500.0, "500.0"), (1000.0, "1.00K"), (1290.66791, "1.29K"), (1000000.0, "1.00M"), (999999.999, "1000.00K"),
    (-52002.78, "-52002.78"), (-12345678.5, "-12345678.5"), (0.0, "0.0"), (0.1 + 0.2, "0.30000000000000004"),
    (1e-5, "1e-05"), (999.99, "999.99"), (1005.0, "1.00K"), (1015.0, "1.01K"), (1025.0, "1.02K"), (123.456, "123.456"),
    (2500000.0, "2.50M"), (1234567890.0, "1234.57M"), (1e15, "1000000000.00M"), (-0.5, "-0.5"), (-1e16, "-1e+16"),
]
NUMBERS = [
    500.0, 1000.0, 1290.66791, 1000000.0, 999999.999, -52002.78, -12345678.5, 0.0, 0.1 + 0.2, 1e-5,
    0.0005, 0.002, -1e16, -1.25e17, -9.5e22, 1005.0, 1015.0, 1025.0, 2.675, 1e15, 123.456, -1e7,
    -0.5, 1e-10, float("nan"), float("inf"), float("-inf"),
]


def test_format_dollars(spark):
    df = spark.createDataFrame([(v,) for v, _ in MONEY], "v double")
    got = {row.v: row.text for row in df.select("v", format_dollars("v").alias("text")).collect()}
    assert got == dict(MONEY)


def test_format_dollars_keeps_missing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.select(format_dollars("v")).first()[0] is None


def test_plain_number_is_python_text(spark):
    finite = [v for v in NUMBERS if math.isfinite(v)]
    df = spark.createDataFrame([(v,) for v in finite], "v double")
    got = {r.v: r.t for r in df.select("v", plain_number("v").alias("t")).collect()}
    assert got == {v: str(v) for v in finite}


def test_division_edges(spark):
    df = spark.createDataFrame([(6.0, 3.0), (5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (0.0, 5.0)], "a double, b double")
    rows = df.select(safe_div("a", "b").alias("s"), float_div("a", "b").alias("f")).collect()
    assert [r.s for r in rows] == [2.0, 0.0, 0.0, None, 0.0]
    assert [r.f for r in rows] == [2.0, math.inf, -math.inf, None, 0.0]


def test_strip_takes_all_white_space(spark):
    texts = ["  a b  ", "\t\nx\r\n", " nbsp ", "\x1fsep\x1c", "", "   ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(strip_ws("t")).collect()]
    assert got == [t if t is None else t.strip() for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=200))
def test_round_half_even_equals_array_rounding(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_even("v")).collect()]
    assert got == np.round(values, 2).tolist()


def test_round_half_even_ties(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (1.015,), (2.5,)], "v double")
    assert [r[0] for r in df.select(round_half_even("v")).collect()] == [0.12, 0.38, 1.01, 2.5]


def test_exact_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert df.agg(exact_sum("v")).first()[0] == 0.0


def test_exact_sum_has_no_drift(spark):
    df = spark.range(100_000).select(F.lit(0.1).alias("v"))
    assert df.agg(exact_sum("v")).first()[0] == 10_000.0


# Textbook values of the t distribution.
@pytest.mark.parametrize("df, t", [(1, 12.706205), (10, 2.228139), (30, 2.042272), (1e9, 1.959964)])
def test_critical_values(df, t):
    assert critical_value(np.array([0.95]), np.array([float(df)]))[0] == pytest.approx(t, abs=1e-6)


def test_two_sided_p_values():
    assert two_sided_p(np.array([2.0]), np.array([10.0]))[0] == pytest.approx(0.073388, abs=1e-6)
    # df = 1 is the Cauchy distribution, df = 2 has a closed form
    t = np.array([0.0, 0.3, 1.0, 7.0, 300.0])
    cauchy = 1 - 2 * np.arctan(t) / math.pi
    assert two_sided_p(t, np.full(5, 1.0)) == pytest.approx(cauchy, abs=1e-12)
    assert two_sided_p(t, np.full(5, 2.0)) == pytest.approx(1 - t / np.sqrt(2 + t * t), abs=1e-12)
    # both branches agree where they meet
    near = two_sided_p(np.full(2, 1.7), np.array([999.999999, 1000.0]))
    assert near[0] == pytest.approx(near[1], rel=1e-7)


def test_t_functions_need_no_package_on_executors(tmp_path):
    dump = tmp_path / "f.pkl"
    dump.write_bytes(cloudpickle.dumps((two_sided_p, critical_value)))
    code = (
        f"import pickle, numpy as np; p, c = pickle.load(open({str(dump)!r}, 'rb')); "
        "print(round(p(np.array([2.0]), np.array([10.0]))[0], 6), round(c(np.array([0.95]), np.array([10.0]))[0], 6))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.split() == ["0.073388", "2.228139"], done.stderr


def test_t_functions_on_columns(spark):
    df = spark.createDataFrame([(2.0, 10.0), (None, 10.0), (2.0, 0.0)], "t double, df double")
    rows = df.select(t_two_sided_p(F.col("t"), F.col("df")).alias("p"), t_critical(0.95, F.col("df")).alias("c")).collect()
    assert rows[0].p == pytest.approx(0.073388, abs=1e-6)
    assert rows[0].c == pytest.approx(2.228139, abs=1e-6)
    assert rows[1].p is None and rows[2].p is None and rows[2].c is None
