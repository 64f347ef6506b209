"""A writable Spark format for services: tasks stage their rows in batches, the job commits them once.

``df.write.format("keyed_folder").option("path", p).option("batch", 500).mode("append").save()``

Every task attempt stages under a name of its own. When all tasks are through, the attempts that
Spark counts are committed together; until then nothing they wrote is seen. An attempt that fails
discards what it staged, a job that fails discards the rest, and what a lost executor leaves behind is
in no receipt. ``service_format`` makes the same of any service with the four calls of ``Service``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quayside.operators.load import dedup
from quayside.sinks.partitioned import RetryPolicy, batch_rows

RECEIPT = "job string, at long, replaces boolean, attempts array<string>, batches long, rows long, largest long, keys array<string>, schema string"


class Service(Protocol):
    """What a format needs of a service; opened anew in every task and for the commit."""

    def stage(self, attempt: str, number: int, rows: pa.Table) -> None: ...

    def discard(self, prefix: str) -> None: ...

    def commit(self, receipt: dict) -> None: ...

    def close(self) -> None: ...


class FolderService:
    """A folder of Parquet files that counts what its receipts name. Paths are those of pyarrow."""

    def __init__(self, options: Mapping[str, str]):
        from pyarrow import fs

        path = options["path"]
        if path.startswith("file:/") and not path.startswith("file://"):
            path = path.replace("file:/", "file:///", 1)
        self.fs, self.root = fs.FileSystem.from_uri(path)

    def _put(self, folder: str, name: str, write: Callable) -> None:
        """A file appears whole under its name or not at all; its draft is hidden from readers."""
        self.fs.create_dir(folder, recursive=True)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            write(out)
        self.fs.move(draft, f"{folder}/{name}")

    def stage(self, attempt: str, number: int, rows: pa.Table) -> None:
        from pyarrow import parquet

        self._put(f"{self.root}/staged/{attempt}", f"{number:06d}.parquet", lambda out: parquet.write_table(rows, out))

    def staged(self) -> list:
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(f"{self.root}/staged", allow_not_found=True))

    def discard(self, prefix: str) -> None:
        """Delete what attempts whose name begins so have staged."""
        for info in self.staged():
            if info.base_name.startswith(prefix):
                self.fs.delete_dir(info.path)

    def commit(self, receipt: dict) -> None:
        name = f"{receipt['at']:016d}-{receipt['job']}.json"
        self._put(f"{self.root}/receipts", name, lambda out: out.write(json.dumps(receipt).encode()))

    def close(self) -> None:
        pass


class StagedWriter(DataSourceArrowWriter):
    """One job: batches are staged by its tasks and committed by the driver."""

    def __init__(self, open_service: Callable[[Mapping[str, str]], Service], schema: StructType, options: Mapping[str, str], overwrite: bool):
        given = {k.lower(): v for k, v in options.items()}
        self.open_service, self.options, self.overwrite, self.schema = open_service, given, overwrite, schema.json()
        self.keys = [k.strip() for k in given.get("keys", "").split(",") if k.strip()]
        missing = [k for k in self.keys if k not in schema.names]
        if missing:
            raise ValueError(f"{', '.join(missing)}: no such column to be a key")
        wanted, cells = (int(given[k]) if k in given else None for k in ("batch", "cells"))
        self.size = batch_rows(len(schema.names), wanted, cells)
        times = {k: float(given[f"retry_{k}"]) for k in ("first", "factor", "longest", "total") if f"retry_{k}" in given}
        self.retry, self.job = RetryPolicy(**times), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task = TaskContext.get()
        attempt = f"{self.job}-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        service, sent, rows, largest, held = self.open_service(self.options), 0, 0, 0, []
        try:
            def flush() -> None:
                nonlocal sent, rows, largest
                batch, number = pa.Table.from_batches(held), sent
                self.retry.run(lambda: service.stage(attempt, number, batch))
                sent, rows, largest = sent + 1, rows + batch.num_rows, max(largest, batch.num_rows)
                held.clear()

            for received in iterator:
                start = 0
                while start < received.num_rows:
                    piece = received.slice(start, self.size - sum(b.num_rows for b in held))
                    held.append(piece)
                    start += piece.num_rows
                    if sum(b.num_rows for b in held) == self.size:
                        flush()
            if held:
                flush()
        except BaseException:
            service.discard(attempt)
            raise
        finally:
            service.close()
        message = WriterCommitMessage()
        message.attempt, message.batches, message.rows, message.largest = attempt, sent, rows, largest
        return message

    def commit(self, messages: list) -> None:
        told = [m for m in messages if m is not None]
        service = self.open_service(self.options)
        receipt = {
            "job": self.job, "at": time.time_ns() // 1_000_000, "replaces": self.overwrite, "attempts": [m.attempt for m in told if m.batches],
            "batches": sum(m.batches for m in told), "rows": sum(m.rows for m in told), "largest": max((m.largest for m in told), default=0),
            "keys": self.keys, "schema": self.schema,
        }
        try:
            self.retry.run(lambda: service.commit(receipt))
        finally:
            service.close()

    def abort(self, messages: list) -> None:
        # attempts that were killed have sent no message, but their names begin with the job's
        service = self.open_service(self.options)
        try:
            service.discard(self.job)
        finally:
            service.close()


def service_format(name: str, open_service: Callable[[Mapping[str, str]], Service]) -> type[DataSource]:
    """A format that writes to what ``open_service`` makes of the options. Register it with
    ``spark.dataSource.register``.

    Options, besides the service's own: ``batch`` rows and ``cells`` of a batch, ``keys``, and the
    times of the retry policy as ``retry_first``, ``retry_factor``, ``retry_longest``, ``retry_total``.
    """

    class StagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
            return StagedWriter(open_service, schema, self.options, overwrite)

    return StagedSource


def register(spark: SparkSession) -> None:
    """Make ``keyed_folder`` a format of the session."""
    spark.dataSource.register(service_format("keyed_folder", FolderService))


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed job."""
    return spark.read.schema(RECEIPT).json(f"{path}/receipts")


def vacuum(spark: SparkSession, path: str, hours: float = 24.0) -> int:
    """Delete what attempts of no receipt staged over so many hours ago, and say how many they were."""
    service, gone = FolderService({"path": path}), 0
    counted = {r[0] for r in receipts(spark, path).select(F.explode("attempts")).toLocalIterator()}
    for info in service.staged():
        if info.base_name not in counted and info.mtime.timestamp() <= time.time() - 3600 * hours:
            service.discard(info.base_name)
            gone += 1
    return gone


def committed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of committed jobs since the last one that replaces, with ``_at`` and ``_job``.

    Staged files carry their attempt in their path; those of no receipt fall out of the join.
    """
    told = receipts(spark, path)
    last = told.orderBy(F.col("at").desc(), F.col("job").desc()).select("schema").first()
    if last is None:
        raise ValueError(f"nothing is committed in {path}")
    schema = StructType.fromJson(json.loads(last["schema"]))
    start = told.where("replaces").agg(F.max(F.struct("at", "job")).alias("since")).first()["since"]
    counted = told if start is None else told.where(F.struct("at", "job") >= F.struct(F.lit(start["at"]).cast("long").alias("at"), F.lit(start["job"]).alias("job")))
    named = counted.select(F.explode("attempts").alias("_attempt"), F.col("at").alias("_at"), F.col("job").alias("_job"))
    if named.isEmpty():
        return spark.createDataFrame([], schema).select("*", F.lit(0).cast("long").alias("_at"), F.lit("").alias("_job"))
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/staged")
    attempt = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.withColumn("_attempt", attempt).join(named, "_attempt").drop("_attempt").select(*schema.names, "_at", "_job")


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The row of each key that was committed last. A job holds one row per key."""
    return dedup(committed(spark, path), keys, ["_at", "_job"]).drop("_at", "_job")
