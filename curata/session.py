"""Session defaults and scratch tables in the folder all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators rely on for right results, and those that only help speed.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the library's settings; a cluster brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("curata")
    settings = SESSION_CONF | {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables: under spark.checkpoint.dir, which all executors reach.

    Only where that setting is unset, and the master is local, a temporary folder of this machine is used.
    """
    app = spark.sparkContext.applicationId
    if app in _own:
        return _own[app]
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="curata-")
    path = _own[app] = f"{base.rstrip('/')}/curata-{app}-{os.getpid()}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may already be gone
        pass


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df once as a table of the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, each query's shuffle files are removed as it ends, not when the driver happens to collect its garbage. For steps that write their results."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
