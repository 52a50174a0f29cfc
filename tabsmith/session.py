"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The JVM interprets methods above this many bytes of code. Whole-stage code of a wide projection
# gets there; above this limit Spark uses projections it can split into small methods instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
}


def build_session(app_name: str = "tabsmith", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, unless their path names it already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        # one process: its working directory is shared by definition
        folder = os.path.join(os.getcwd(), "spark-warehouse", "tabsmith-shared")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder


_run = ""  # the folder of the job that is running, below the shared folder


def work_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, for a table that one job writes and reads back."""
    return os.path.join(shared_dir(spark), "tabsmith", *filter(None, [_run]), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def job_folder(spark: SparkSession):
    """What is staged inside goes to one folder that is removed at the end; results must be written elsewhere."""
    global _run
    before, _run = _run, f"job-{uuid.uuid4().hex}"
    folder = os.path.join(shared_dir(spark), "tabsmith", _run)
    try:
        yield folder
    finally:
        _run = before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df, name: str):
    """Write `df` to the shared folder and read it back.

    Cuts the lineage at a table that survives lost executors, and lets each
    later pass read only the columns it needs.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
