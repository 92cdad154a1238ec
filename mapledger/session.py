"""Session settings for local runs, and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "mapledger") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MAPLEDGER_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


# Folders of local applications without a checkpoint folder of their own.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing, a session whose executors are threads of the driver gets a folder of
    its own under the temporary directory; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="mapledger-")
        return _LOCAL_FOLDERS[application]
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


# Tables of the job that runs, if one is declared.
_JOB: ContextVar[list[str] | None] = ContextVar("mapledger_job", default=None)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside the block are removed at its end, however it ends.

    DataFrames made inside are to be read, written elsewhere or named by ``materialize_result`` before
    that. Blocks may be nested; each removes its own tables. Without a block tables stay.
    """
    mine: list[str] = []
    token = _JOB.set(mine)
    try:
        yield
    finally:
        _JOB.reset(token)
        for path in mine:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh_path(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """An unused path below the shared folder; a ``lasting`` one does not end with its job."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    mine = _JOB.get()
    if mine is not None and not lasting:
        mine.append(path)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files: they go with the job, not with the driver's next garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors, so that a relation read
    by several branches of a plan is computed once. ``job`` says when it is removed. The shuffles
    behind the table go as soon as it is written, so what a chain of tables takes of the disks is
    the tables and the shuffles of one step.
    """
    path = path or fresh_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
