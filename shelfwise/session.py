"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
#: Scopes of this thread or task, from outside in.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


# Adaptive execution picks broadcast joins from measured shuffle sizes, merges
# small shuffle partitions and splits skewed join partitions. The last setting
# lets it split a join whose output feeds an aggregate on the same key, at the
# price of one more shuffle in that case only.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    master: str | None = None, app_name: str = "shelfwise", partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the operators rely on; ``partitions`` as in :func:`tune`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (ADAPTIVE | fixed | conf).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate(), partitions)


def tune(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Switch the adaptive settings on in a session built elsewhere.

    ``partitions`` is the number that shuffles start with, on any master; adaptive
    execution merges those it does not need. Without it the session's own setting
    holds. Choose it so that the largest shuffle gives partitions of 100 to 200 MB:
    about 100,000 for shuffles of 15 TB.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    if partitions:
        spark.conf.set(INITIAL, str(partitions))
    return spark


class NoSharedFolder(RuntimeError):
    """Intermediate tables have no folder that all executors can reach."""


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    session in one process uses a temporary folder; any other session raises
    :class:`NoSharedFolder`. A ``file:`` folder is taken as named: it must be a
    mount that all machines share.
    """
    context = spark.sparkContext
    app = context.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="shelfwise-")
            atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
        base = _local_dirs[app]
    return "/".join([base.rstrip("/"), "shelfwise", app, *_scopes.get()])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables written inside, deleted at the end.

    Results that still read from it must be written or collected before.
    """
    token = _scopes.set((*_scopes.get(), f"scope-{uuid.uuid4().hex}"))
    folder = shared_dir(spark)
    try:
        yield folder
    finally:
        _scopes.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no one has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of it.

    Used where several branches of a plan read one result: the upstream work
    runs once, the branches prune columns and push filters on the written
    files, and a lost executor costs no recomputation. The table stays until its
    :func:`scratch_scope` ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
