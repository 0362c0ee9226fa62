"""Scalar column functions: division, trimming, rounding, exact sums, money text.

Arguments are column names or SQL expressions; the result is one built-in
expression, evaluated inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is loaded with four decimals, so sums in this type lose nothing.
MONEY = "decimal(28,4)"

# Whitespace that a text strip removes: Unicode white space and the four
# information separators.
STRIP_PATTERN = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _double(value: str) -> str:
    return f"CAST(({value}) AS DOUBLE)"


def float_div(num: str, den: str) -> Column:
    """Floating division: x/0 is a signed infinity, 0/0 is null."""
    num, den = _double(num), _double(den)
    return F.expr(
        f"CASE WHEN {den} <> 0 THEN {num} / {den} WHEN {num} > 0 THEN DOUBLE('inf') "
        f"WHEN {num} < 0 THEN DOUBLE('-inf') END"
    )


def safe_div(num: str, den: str) -> Column:
    """Floating division with x/0 taken as 0; 0/0 is null."""
    num, den = _double(num), _double(den)
    return F.expr(f"CASE WHEN {den} <> 0 THEN {num} / {den} WHEN {num} <> 0 THEN 0D END")


def strip_ws(value: str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(value, STRIP_PATTERN, "")


def round_half_even(value: str, digits: int = 2) -> Column:
    """Round as array libraries do: scale, round to even, scale back."""
    scale = f"{10**digits}D"
    return F.expr(f"rint({_double(value)} * {scale}) / {scale}")


def exact_sum(value: str) -> Column:
    """Sum of money or counts that does not depend on row order; empty is 0."""
    return F.expr(f"coalesce(CAST(sum(CAST(({value}) AS {MONEY})) AS DOUBLE), 0D)")


def _plain(value: str) -> str:
    number, text = _double(value), f"CAST({_double(value)} AS STRING)"
    digits = f"CAST(try_cast({text} AS DECIMAL(38,20)) AS STRING)"
    fixed = rf"regexp_replace(regexp_replace({digits}, '0+$', ''), r'\.$', '.0')"
    # 1.0E16 -> 1e+16, 1.0E-5 -> 1e-05
    power = rf"regexp_replace(regexp_replace({text}, r'\.0E', 'E'), r'E(\d)', 'e+$1')"
    power = rf"regexp_replace(replace({power}, 'E-', 'e-'), r'e([+-])(\d)$', 'e$10$2')"
    return (
        f"CASE WHEN isnan({number}) THEN 'nan' "
        f"WHEN {number} = DOUBLE('inf') THEN 'inf' WHEN {number} = DOUBLE('-inf') THEN '-inf' "
        f"WHEN {number} = 0 OR abs({number}) >= 1e-3 AND abs({number}) < 1e7 THEN {text} "
        f"WHEN abs({number}) >= 1e-4 AND abs({number}) < 1e16 THEN {fixed} ELSE {power} END"
    )


def plain_number(value: str) -> Column:
    """Shortest text of a double: fixed notation from 1e-4 up to 1e16."""
    return F.expr(_plain(value))


def format_dollars(value: str) -> Column:
    """``1.29M`` from a million, ``1.29K`` from a thousand, else the plain number."""
    number = _double(value)
    # NaN sorts above every number in Spark, so it is kept out of the first branches.
    return F.expr(
        f"CASE WHEN isnan({number}) THEN 'nan' WHEN {number} = DOUBLE('inf') THEN 'infM' "
        f"WHEN {number} >= 1000000 THEN concat(format_number({number} / 1000000, '0.00'), 'M') "
        f"WHEN {number} >= 1000 THEN concat(format_number({number} / 1000, '0.00'), 'K') "
        f"WHEN {number} IS NOT NULL THEN {_plain(value)} END"
    )
