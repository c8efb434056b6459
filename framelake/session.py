"""Sessions, folders that driver and executors share, and the package's way to executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]


def session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; `conf` overrides."""
    given = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    } | conf
    return SparkSession.builder.master(master).config(map=given).getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, and so share this machine's folders and variables."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package: a zip is added once, but in local mode where the workers'
    path, which is the driver's, has it already."""
    if is_local(spark) and str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if getattr(sc, "_framelake_shipped", False):
        return
    base = Path(tempfile.mkdtemp(prefix="framelake-zip-"))
    sc.addPyFile(shutil.make_archive(str(base / "framelake"), "zip", ROOT, "framelake"))
    sc._framelake_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    In local mode a temporary folder is made and set where the setting is absent; on a cluster its
    absence is an error, as executors would write to their own disks.
    """
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        there = found.get() if found.isDefined() else None
    if not there and not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not there:
        there = "file://" + tempfile.mkdtemp(prefix="framelake-")
        spark.sparkContext.setCheckpointDir(there)
    return there


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again: what it took is not computed twice, and not
    lost with an executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
