"""Sessions and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # what was settled goes once nothing refers to it
    } | conf
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context: their Python workers need not find it on a path of their own."""
    context = spark.sparkContext
    if getattr(context, "_sightline_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="sightline-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).resolve().parent
    target = os.path.join(folder, "sightline-code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(target)
    context._sightline_shipped = True


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's spark.checkpoint.dir; on one machine a temporary one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    held = context._jsc.sc().getCheckpointDir()
    if not folder and not held.isEmpty():
        folder = held.get()
    if not folder:
        if not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sightline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        folder = f"file://{folder}"
    if held.isEmpty():
        context.setCheckpointDir(folder)
    return folder


def files(spark: SparkSession, path: str):
    """(file system, path) of a path anywhere, by Hadoop's interface: local, HDFS or object storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder: later steps read the same rows, also after executors are lost."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")
