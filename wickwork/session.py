"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def build_session(app_name: str = "wickwork", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` wins over all of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        # Runtime re-planning: coalesces small shuffle partitions, splits skewed ones, and
        # turns a join into a broadcast only after the side's real size is known.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Checkpoints that nothing refers to any more are deleted.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Put this package on the path of Python workers that see the driver's folders; elsewhere it is installed or sent along."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only by a local master, where driver and
    executors are one process.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="wickwork-")
    return _local_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results that several later steps need: they then see the same rows, and a lost
    executor costs a re-read of files and not a re-run of the plan that made them.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``staged`` for the length of a ``with`` block; the files are dropped at its end."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
