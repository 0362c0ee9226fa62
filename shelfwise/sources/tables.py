"""Catalog and file tables: list, scan, create, replace."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the tables and views in a database."""
    names = [(t.name,) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, "table string").orderBy("table")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """All columns of a catalog table or view."""
    return spark.table(name)


def ensure_table(
    spark: SparkSession, name: str, schema: StructType | str, location: str | None = None
) -> DataFrame:
    """Create an empty typed Parquet table unless it exists, and return it."""
    ddl = schema.toDDL() if isinstance(schema, StructType) else schema
    quoted = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{quoted}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{place}")
    return spark.table(name)


def write_table(
    df: DataFrame, target: str, cluster_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> None:
    """Replace a target: a path when it holds a slash, else a catalog table.

    The new table is written beside the old one and takes its name when it is
    complete. If anything fails, the old one stays or comes back, and what was
    written is removed; so ``df`` may read the target itself. On a file system
    without atomic renames readers may find no table for the time of two renames.

    ``cluster_by`` names columns that filters use: see :func:`clustered`; ``options``
    go to the writer.
    """
    mark = uuid.uuid4().hex[:12]
    options = dict(options or {})
    if cluster_by:
        df, options = clustered(df, cluster_by), layout_options(cluster_by) | options
    swap = _swap_paths if "/" in target else _swap_tables
    swap(df, target.rstrip("/"), mark, options)


#: Bytes of a Parquet row group of a clustered table: small, so that a key's rows fill few of them.
ROW_GROUP = 16 << 20


def layout_options(cluster_by: Sequence[str], row_group: int = ROW_GROUP, distinct: int = 1_000_000) -> dict[str, str]:
    """Writer options of clustered tables: small row groups, and Bloom filters on the columns for exact look-ups.

    The least and largest values of a row group leave out most groups for the first
    column; the filters do so for the others, and within groups that span many keys.
    ``distinct`` is the number of values that a filter is sized for.
    """
    options = {"parquet.block.size": str(row_group)}
    for name in cluster_by:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{name}"] = str(distinct)
    return options


def clustered(df: DataFrame, cluster_by: Sequence[str]) -> DataFrame:
    """Rows dealt by ranges of the columns and in their order within a partition.

    A hash of the whole row ends the range key, so that the rows of one hot key go to
    several partitions.
    """
    tie = F.xxhash64(*[F.col(_quoted(c)) for c in df.columns])
    columns = [F.col(_quoted(c)) for c in cluster_by]
    return df.repartitionByRange(*columns, tie).sortWithinPartitions(*columns)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _swap_paths(df: DataFrame, target: str, mark: str, options: dict[str, str]) -> None:
    spark = df.sparkSession
    head, _, name = target.rpartition("/")
    # names that begin with a point are hidden from readers of the folder
    paths = (target, f"{head}/.{name}-new-{mark}", f"{head}/.{name}-old-{mark}")
    there, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths)
    files = there.getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(a, b) -> None:
        if not files.rename(a, b):
            raise OSError(f"{a} was not renamed to {b}")

    try:
        df.write.options(**options).parquet(paths[1])
        if files.exists(there):
            rename(there, old)
        try:
            rename(new, there)
        except BaseException:
            if files.exists(old):
                rename(old, there)
            raise
    finally:
        files.delete(new, True)
    files.delete(old, True)


def _swap_tables(df: DataFrame, target: str, mark: str, options: dict[str, str]) -> None:
    spark = df.sparkSession
    new, old = f"{target}_new_{mark}", f"{target}_old_{mark}"
    try:
        df.write.format("parquet").options(**options).saveAsTable(new)
        kept = spark.catalog.tableExists(target)
        if kept:
            spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
        except BaseException:
            if kept:
                spark.sql(f"ALTER TABLE {old} RENAME TO {target}")
            raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
    if kept:
        spark.sql(f"DROP TABLE {old}")


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_by: str,
    bounds: tuple[int, int],
    parts: int,
    **properties: str,
) -> DataFrame:
    """All columns of a database table, read in ``parts`` ranges of a number column."""
    low, high = bounds
    return spark.read.jdbc(url, table, split_by, low, high, parts, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 20_000, **properties: str) -> None:
    """Replace a database table, inserting in batches from every partition."""
    writer = df.write.mode("overwrite").option("batchsize", batch)
    writer.jdbc(url, table, properties=properties)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """Scan what :func:`write_table` wrote."""
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def head(df: DataFrame, order: Sequence = (), n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order, or any ``n`` rows for a quick look."""
    return (df.orderBy(*order) if order else df).limit(n)


def key_rows(df: DataFrame, value: int, key: str = "VendorNumber") -> DataFrame:
    """All rows of one key value."""
    return df.where(F.col(key) == value)
