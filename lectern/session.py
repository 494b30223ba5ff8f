"""Session defaults, shared scratch space and table loading."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only on a local master, where all is one machine, a temporary one is made if none is
    named; it goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lectern-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives executor loss."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held.settled_at = path
    return held


def discard(*held: DataFrame) -> None:
    """Remove tables that ``settle`` wrote and that nothing reads any more."""
    for df in held:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.settled_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Settings of ``lean``: shuffle files go when their action ends, tables take half the space of Snappy's.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """In this block actions leave no shuffle files until the driver collects its garbage, and tables are packed harder."""
    before = {key: spark.conf.get(key, None) for key in LEAN}
    for key, value in LEAN.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Deal a small local file over ``spark.lectern.spread`` tasks, where that is set.

    For tests and single machines, whose tables are one row group. A cluster leaves the
    setting out: its tables are read in splits and raw rows are never shuffled.
    """
    tasks = df.sparkSession.conf.get("spark.lectern.spread", None)
    return df.repartition(int(tasks)) if tasks else df


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
