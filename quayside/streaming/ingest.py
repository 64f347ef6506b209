"""Streams into typed tables, keyed logs and message sinks.

Every sink here may see a batch twice after a failure; each leaves the same result either way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.schema import ColumnSpec, typed_projection
from quayside.sinks.messages import message_rows
from quayside.sources.listing import marker_of, with_table
from quayside.streaming.levels import FAN, LevelledLog

BATCH = "batch_id"
# Batches in which files that wait already are taken, about.
CATCH_UP = 24


def text_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, archive_to: str | None = None
) -> DataFrame:
    """Lines of files as they arrive; a Kafka source gives the same ``value`` column.

    With ``archive_to``, files are put away there once their batch is committed. A batch takes
    ``files_per_trigger`` files, or more if that many wait that it would be over ``CATCH_UP`` batches:
    each has a cost of its own, whatever its size, so many small files are not taken a few at a time.
    """
    reader = spark.readStream.format("text")
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max(files_per_trigger, -(-waiting_files(spark, path) // CATCH_UP)))
    return reader.load(path)


def waiting_files(spark: SparkSession, path: str) -> int:
    """How many files a folder, or all folders of a pattern, hold."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(s.getPath()).getFileCount() for s in fs.globStatus(folder) or [])


def typed_records(lines: DataFrame, specs: Sequence[ColumnSpec], rejects: str | None = "rejects") -> DataFrame:
    """JSON records to typed columns: the same projection a batch load uses."""
    fields = {s.source_name: T.StructField(s.source_name, T.StringType()) for s in specs}
    parsed = F.from_json(F.col("value").cast("string"), T.StructType(list(fields.values())))
    return typed_projection(lines.select(parsed.alias("record")).select("record.*"), specs, rejects)


def append_to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append each batch to files exactly once, and stop when the source is used up."""
    return (
        stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start(path)
    )


def upsert_log(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], fan: int = FAN
) -> StreamingQuery:
    """Keep the newest row per key in a levelled log; see ``LevelledLog``.

    A batch is known by its checkpoint and number, so one that runs again changes nothing, and its
    work follows the batch, not the table. ``current_rows`` reads the result.
    """
    log = LevelledLog(stream.sparkSession, path, keys, order, fan)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.add(batch, f"{checkpoint}:{batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key over all batches; of equal rows the later batch wins."""
    return LevelledLog(spark, path, keys, order).rows()


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold all that a log holds into one run."""
    LevelledLog(spark, path, keys, order).compact()


FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


def arrivals(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Files as they arrive, by name and time; their contents are not read."""
    stream = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    )
    return stream.select("path", F.col("modificationTime").alias("modified"))


STATE = "path string, table_name string"
VERDICT = "table_name string, n_files long, n_unmarked long, ready boolean"


def _of_batch(spark: SparkSession, folder: str, batch_id: int, schema: str) -> DataFrame:
    """What a batch wrote into its folder; nothing if there was no such batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{BATCH}={batch_id}")
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(path.toString()) if known else spark.createDataFrame([], schema)


def gate_arrivals(
    stream: DataFrame, log: str, ready: str, checkpoint: str,
    patterns: Mapping[str, str], suffix: str, marker_suffix: str,
) -> StreamingQuery:
    """After each batch, write which tables have all their files marked as complete.

    What goes from batch to batch is state, not history: files that wait for their marker and
    markers that wait for their file (without a table), and one row per table. A batch reads the
    state of the one before it and writes its own, so its cost follows what is new or waiting, and a
    replay rewrites its own folders only. A marker serves the files that wait for it or come with it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch.select("path").distinct()
        markers = seen.where(F.endswith(F.col("path"), F.lit(marker_suffix))).withColumn("table_name", F.lit(None).cast("string"))
        new = with_table(seen, patterns).select("path", "table_name")
        # read twice, once for the state and once for the verdict
        waiting = _of_batch(spark, log, batch_id - 1, STATE).unionByName(new).unionByName(markers).distinct()
        files = waiting.where("table_name is not null").withColumn("_want", marker_of("path", suffix, marker_suffix))
        marks = waiting.where("table_name is null").select(F.col("path").alias("_marker"))
        unmarked = files.join(marks, F.col("_want") == F.col("_marker"), "left_anti").select("path", "table_name")
        unused = marks.join(files, F.col("_want") == F.col("_marker"), "left_anti")
        state = unmarked.unionByName(unused.select(F.col("_marker").alias("path"), F.lit(None).cast("string").alias("table_name")))
        state.write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")

        counts = _of_batch(spark, ready, batch_id - 1, VERDICT).select("table_name", "n_files", F.lit(0).cast("long").alias("n_unmarked"))
        counts = counts.unionByName(new.select("table_name", F.lit(1).cast("long").alias("n_files"), F.lit(0).cast("long").alias("n_unmarked")))
        left = _of_batch(spark, log, batch_id, STATE).where("table_name is not null")
        counts = counts.unionByName(left.select("table_name", F.lit(0).cast("long").alias("n_files"), F.lit(1).cast("long").alias("n_unmarked")))
        verdict = counts.groupBy("table_name").agg(F.sum("n_files").alias("n_files"), F.sum("n_unmarked").alias("n_unmarked"))
        verdict.withColumn("ready", F.col("n_unmarked") == 0).write.mode("overwrite").parquet(f"{ready}/{BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_verdict(spark: SparkSession, ready: str) -> DataFrame:
    """The newest verdict on each table."""
    rows = spark.read.parquet(ready)
    rest = [c for c in rows.columns if c not in ("table_name", BATCH)]
    last = F.max_by(F.struct(*rest), F.col(BATCH)).alias("last")
    return rows.groupBy("table_name").agg(last).select("table_name", "last.*")


def publish_stream(stream: DataFrame, fmt: str, options: Mapping[str, str], checkpoint: str, partition_key: str | None = None) -> StreamingQuery:
    """Send every row as a JSON message, resuming from the checkpoint."""
    return (
        message_rows(stream, partition_key).writeStream.format(fmt).options(**options)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def without_replays(stream: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other; state stays bounded."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))
