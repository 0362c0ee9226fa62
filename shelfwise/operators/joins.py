"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


#: A key with more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000
#: Keys that the sketch of frequent keys keeps; it finds every key of more than 0.03 % of the rows.
TRACKED = 10_000


def hot_keys(df: DataFrame, *keys: Sequence[str]) -> list[Column]:
    """For each list of key columns the hashes of its hot keys, as a value of the plan: one array of a bounded size.

    One scan of the key columns into a mergeable sketch of frequent items for each
    list. Give the raw table: a key that is not hot in it has few groups after an
    aggregate, too, so no task joins more than ``HOT_SHARE`` of the raw rows for it.
    """
    most = round(1 / HOT_SHARE)
    lists = [
        F.expr(
            f"transform(filter(approx_top_k(xxhash64({', '.join(f'`{c}`' for c in names)}), {most}, {TRACKED}), "
            f"x -> x.count > count(1) * {HOT_SHARE!r}D), x -> x.item)"
        ).alias(f"k{i}")
        for i, names in enumerate(keys)
    ]
    found = df.agg(*lists).select(F.struct("*").alias("hot")).scalar()
    return [found[f"k{i}"] for i in range(len(keys))]


def copies(right: DataFrame, keys: Sequence[str], salts: int, hot: Column | None = None) -> DataFrame:
    """The rows with ``_salt``: those of hot keys once for each salt, the others once."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        every = F.when(_is_hot(keys, hot), every).otherwise(F.array(F.lit(0)))
    return right.withColumn("_salt", F.explode(every))


def _is_hot(keys: Sequence[str], hot: Column) -> Column:
    return F.coalesce(F.array_contains(hot, F.xxhash64(*[F.col(f"`{k}`") for k in keys])), F.lit(False))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    spread_by: Sequence[Column | str],
    how: str = "left",
    salts: int = SALTS,
    hot: Column | None = None,
) -> DataFrame:
    """Join many ``left`` rows per key with an aggregated ``right`` table.

    Left rows of one key are spread over ``salts`` parts by a hash of
    ``spread_by``; the right row of the key is repeated once per part. With ``hot``
    (see :func:`hot_keys`) this is done for hot keys only and all others are joined
    once. The salt also puts a shuffle of its own under both sides: without it, an
    aggregate on the join key feeds the join directly, and adaptive execution
    cannot split a partition that is still too large. A right side that turns
    out small at run time is broadcast and the left side stays where it is.
    """
    keys = [on] if isinstance(on, str) else list(on)
    part = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    if hot is not None:
        part = F.when(_is_hot(keys, hot), part).otherwise(0)
    return left.withColumn("_salt", part).join(copies(right, keys, salts, hot), [*keys, "_salt"], how).drop("_salt")
