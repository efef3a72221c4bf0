"""Session for tests and benches, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: folder per application where the session names none (local sessions only)
_OWN_FOLDERS: dict[str, str] = {}
#: handles that are recording just now, outermost first
_RECORDING: list["Staged"] = []


def local_session(cores: int | str = 8, app: str = "taxaloom", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own, kept for the application's
    life. On a cluster the setting is required; a path without a scheme, or a ``file:`` path, must
    be a mount that all executors share, and is warned about.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "").startswith("local")
    if path:
        if not local and (path.startswith("file:") or "://" not in path):
            warnings.warn(f"{path}: staged tables need a folder that all executors share", stacklevel=2)
        return path.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="taxaloom-")
    return _OWN_FOLDERS[app]


class Staged:
    """Paths written while a handle records; ``release`` deletes exactly those."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def release(self) -> None:
        """Delete the written tables. Frames that read them must have been stored before."""
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths = []


@contextmanager
def recording(spark: SparkSession) -> Iterator[Staged]:
    """Record what is staged inside the block::

        with recording(spark) as staged:
            plan(...).write.parquet(out)
        staged.release()
    """
    handle = Staged(spark)
    _RECORDING.append(handle)
    try:
        yield handle
    finally:
        _RECORDING.remove(handle)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage_path(spark: SparkSession, tag: str = "stage") -> str:
    """New path in the shared folder, known to the handles that are recording."""
    path = f"{scratch_dir(spark)}/taxaloom/{tag}-{uuid.uuid4().hex}"
    for handle in _RECORDING:
        handle.paths.append(path)
    return path


def stage(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors.

    One file per task and in task order, so a sorted frame keeps its order in
    (file number, row index).
    """
    spark = df.sparkSession
    path = stage_path(spark, tag)
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, metrics: dict[str, Column], tag: str = "stage") -> tuple[DataFrame, dict[str, int]]:
    """``stage``, with aggregates of the rows that are taken while they are written (0 where there are none).

    The metrics stand right below the write, so each written task counts once, however often tasks are repeated.
    """
    observation = Observation()
    staged = stage(df.observe(observation, *[c.alias(name) for name, c in metrics.items()]), tag)
    found = observation.get  # without any row there may be no metrics
    return staged, {name: found.get(name) or 0 for name in metrics}
