"""Where intermediate results go: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import hashlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    A session on one machine that names none gets a temporary one; on a cluster that would lose rows,
    as every executor would write to a disk of its own, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="folioscan-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder



def estimated_bytes(rows: DataFrame) -> int:
    """Spark's own size estimate of the plan; nothing runs for it."""
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{workspace(spark).rstrip('/')}/folioscan/{label}-{uuid.uuid4().hex}"


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove folders of intermediate rows that nothing reads any more, where they are still there."""
    jvm = spark._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows, computed once and stored reliably: lost executors do not change them."""
    if not rows.sparkSession.sparkContext.getCheckpointDir():
        rows.sparkSession.sparkContext.setCheckpointDir(workspace(rows.sparkSession))
    return rows.checkpoint(eager=True)


def written(rows: DataFrame, label: str, owner: str | None = None) -> DataFrame:
    """The rows as a parquet table in the shared folder, so that later reads prune its columns.

    With an ``owner`` (the root of a catalogue, which has one writer) the table replaces the one its
    last batch left, so a long-running stream keeps no more than one batch of intermediate rows.
    """
    spark = rows.sparkSession
    if owner is None:
        path = new_folder(spark, label)
    else:
        name = hashlib.sha256(owner.encode()).hexdigest()[:24]
        path = f"{workspace(spark).rstrip('/')}/folioscan/{label}-{name}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
