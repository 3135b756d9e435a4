"""Spark session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def build_session(app: str = "rolecast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.speculation": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's own setting, in local mode a new one."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="rolecast-")
    return _LOCAL_DIRS[application]


def run_dir(spark: SparkSession) -> str:
    """Folder of the intermediate tables of this application."""
    return f"{shared_dir(spark)}/rolecast/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the run's folder that nobody has used yet."""
    return f"{_SCRATCH.get() or run_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder that takes all intermediate tables of the block and is removed at its end, so
    that work in rounds needs the disk of one round. What is to stay is written to a path
    from before the block."""
    path = new_path(spark, "scratch")
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        remove(spark, path)


def end_run(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application. Frames that read them, such as
    results that were not written yet, are of no use afterwards."""
    remove(spark, run_dir(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder. Only for tables that no frame still reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back, so that later stages neither recompute it
    nor depend on the executors that made it."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table at `path` was written to the end."""
    return exists(spark, f"{path}/_SUCCESS")
