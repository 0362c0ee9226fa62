"""What the operators share: stored tables, Arrow batches, hashes."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import materialize, scratch_path, tune

#: Rows of an Arrow batch. Texts may be long, so batches hold few of them.
BATCH_ROWS = 400

__all__ = ["Sent", "forget_made", "labelled_sample", "materialize", "scratch_path", "map_text", "prepare", "read_table", "sha_hex", "string_type"]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators need: adaptive execution, small Arrow batches."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def string_type(df: DataFrame, columns: Sequence[str]) -> list:
    """Projections of string columns, whatever the type they come in."""
    return [F.col(f"`{c}`").cast("string").alias(c) for c in columns]


def map_text(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[list[Sequence]]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions that yield blocks of columns.

    ``rows`` gets the batches of a partition and yields, for each block of
    results, one sequence for each column of ``schema``.
    """
    spark = prepare(df.sparkSession)
    kinds = spark.createDataFrame([], schema).schema
    types = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
             "array<string>": pa.list_(pa.string())}
    arrow = pa.schema([(f.name, types[f.dataType.simpleString()]) for f in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, arrow.types)]
            if arrays and len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, kinds)


def labelled_sample(df: DataFrame, labels: DataFrame, key: str, text: str, rows: int) -> DataFrame:
    """Rows (label, text) of at most ``rows`` labelled keys, the first by a hash of the key.

    ``labels`` has id and label (0 or 1; others are ignored, of several the larger
    counts). The broadcast side is bounded by ``rows``.
    """
    usable = labels.where(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id")
    sample = usable.agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    docs = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return docs.join(F.broadcast(sample), "id").select("label", "text")


def sha_hex(data: bytes) -> str:
    """Lowercase hexadecimal SHA-256."""
    return hashlib.sha256(data).hexdigest()


_made: dict[str, Any] = {}


class Sent:
    """A value of proven size on all executors, and what a Python worker makes of it once."""

    def __init__(self, spark: SparkSession, value: Any):
        self.name = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast(value)

    def made(self, build: Callable[[Any], Any]) -> Any:
        """``build(value)``, kept in this worker until another value is made: it holds one at a time."""
        if self.name not in _made:
            _made.clear()
            _made[self.name] = build(self.broadcast.value)
        return _made[self.name]


def forget_made() -> None:
    """Drop what this worker keeps for an operator that ran in it before."""
    _made.clear()
