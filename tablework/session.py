"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tablework", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tablework-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; everything else stays as the cluster set it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder of its own. A cluster session without it is
    an error: a machine-local folder there would lose data with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablework-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/tablework-{label}-{uuid.uuid4().hex}"


#: Spark's switch that a statement's shuffle files go when it ends, and not when the driver's memory runs short
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str, codec: str | None = None) -> None:
    """Write a frame as Parquet. Nothing reads the shuffle files of the statement again, so they go at its end."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def pin(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back; ``codec`` is the compression, Spark's own by default.

    Cuts lineage, so that values which depend on how rows met in tasks (partition numbers, positions) are fixed
    once, and a lost executor re-reads files instead of recomputing them differently.
    """
    path = scratch(df.sparkSession, label)
    _write(df, path, codec)
    if (steps := _STEPS.get()) is not None:
        steps.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: folders written by ``pin`` on the way to the result of the innermost ``pin_result``
_STEPS: ContextVar[list[str] | None] = ContextVar("steps", default=None)


def pin_result(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``pin`` the frame that ``build`` gives, then delete all that was pinned while it was built and written.

    The written result reads none of these steps, so nothing needs them again. Frames that ``build`` keeps for other uses
    must be pinned before.
    """
    steps: list[str] = []
    token = _STEPS.set(steps)
    try:
        df = build()
        path = scratch(spark, label)
        _write(df, path)
    finally:
        _STEPS.reset(token)
    if (outer := _STEPS.get()) is not None:
        outer.append(path)
    for step in steps:
        place = spark._jvm.org.apache.hadoop.fs.Path(step)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.schema(df.schema).parquet(path)
