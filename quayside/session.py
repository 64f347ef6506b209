"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates and clock texts are read and rendered in one zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset, a folder of the
    warehouse is used, which tables share as well.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_quayside"


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one; never reused, so a rerun cannot read old output."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder this process has named, and say how many there were.

    For the end of a job: frames that were read from them cannot be used any more.
    """
    jvm, conf, gone = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def saved(df, label: str, partition_by: list[str] | None = None):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and pins the contents: later passes see the same rows even if an executor
    is lost or the source is overwritten meanwhile.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)

