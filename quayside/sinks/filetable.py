"""Tables of Parquet files with a log of versions: replayed loads count once, merges rewrite few files.

A folder holds ``data`` (files, never changed once written), ``index`` (what each file's keys are
like) and ``log``: version n is one small JSON file that names the live files and the loads that made
them. A writer stages files first and then claims the next version; if somebody else was faster, it
looks at the new head and tries again. What was staged by a job that died is in no version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructType, TimestampType

from quayside.sinks.partitioned import RetryPolicy

# Rows of a file that a load or merge writes, on average.
FILE_ROWS = 1_000_000
# Delta keys that are held against every file's index; a larger delta is merged with all files.
MOST_KEYS = 200_000
# Bits of a file's filter per key, and hashes per key: about one false hit in a hundred.
BITS, HASHES = 10, 7
# Keys whose places in a filter are worked out in one go.
CHUNK = 1 << 14
# Loads whose ids a table remembers.
REMEMBERED = 10_000


class CommitConflict(Exception):
    """Another writer took the version."""


@dataclass(frozen=True)
class DataFile:
    path: str
    run: str
    level: int = 0


@dataclass(frozen=True)
class Version:
    """``files`` are live, ``batches`` the ids of loads, ``schema`` the JSON of their columns."""

    number: int = 0
    schema: str | None = None
    files: tuple[DataFile, ...] = ()
    batches: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema, "files": [vars(f) for f in self.files], "batches": self.batches})

    @staticmethod
    def from_json(number: int, text: str) -> Version:
        read = json.loads(text)
        return Version(number, read["schema"], tuple(DataFile(**f) for f in read["files"]), tuple(read["batches"]))


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each key in a filter of ``bits`` (a power of two), from two halves of its hash."""
    h = hashes.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def filter_bits(keys: int) -> int:
    return max(64, 1 << (BITS * max(1, keys) - 1).bit_length())


def add_keys(filter_: np.ndarray, hashes: np.ndarray) -> None:
    """Enter keys into a filter of whole bytes, some at a time."""
    for start in range(0, len(hashes), CHUNK):
        at = np.unique(_positions(hashes[start : start + CHUNK], 8 * len(filter_)))
        np.bitwise_or.at(filter_, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def key_filter(hashes: np.ndarray) -> bytes:
    found = np.zeros(filter_bits(len(hashes)) // 8, dtype=np.uint8)
    add_keys(found, hashes)
    return found.tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    found = np.frombuffer(filter_, dtype=np.uint8)
    out = np.zeros(len(hashes), dtype=bool)
    for start in range(0, len(hashes), CHUNK):
        at = _positions(hashes[start : start + CHUNK], 8 * len(found))
        out[start : start + CHUNK] = ((found[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
    return out


INDEX = "file string, rows long, low double, high double, keys binary"


def _partly_indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``file, h, at, n`` to ``INDEX`` rows of what a task has of each file, whose filters fit
    together; null keys are not in it. A task holds the filter of one file and no keys."""
    name, rows, low, high, found = None, 0, None, None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([name], pa.string()), pa.array([rows], pa.int64()), pa.array([low], pa.float64()),
            pa.array([high], pa.float64()), pa.array([found.tobytes()], pa.binary())], names=[f.split()[0] for f in INDEX.split(", ")])

    for batch in batches:
        files = batch.column(0)
        ends = files.dictionary_encode().indices.to_numpy()
        cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if start == stop:
                continue
            if files[start].as_py() != name:
                if name is not None:
                    yield told()
                name, rows, low, high = files[start].as_py(), 0, None, None
                found = np.zeros(filter_bits(batch.column(3)[start].as_py()) // 8, dtype=np.uint8)
            part = batch.slice(start, stop - start)
            add_keys(found, part.column(1).drop_null().to_numpy())
            at, rows = part.column(2).drop_null().to_numpy(), rows + part.num_rows
            if len(at):
                low = float(at.min()) if low is None else min(low, float(at.min()))
                high = float(at.max()) if high is None else max(high, float(at.max()))
    if name is not None:
        yield told()


def _put_together(parts: pa.Table) -> pa.Table:
    """One row of ``INDEX`` of the parts of a file: as many as tasks that read of it."""
    found = np.zeros(len(parts.column("keys")[0].as_buffer()), dtype=np.uint8)
    for keys in parts.column("keys"):
        found |= np.frombuffer(keys.as_buffer(), dtype=np.uint8)
    return pa.table({
        "file": parts.column("file").slice(0, 1), "rows": pa.array([pa.compute.sum(parts.column("rows")).as_py()], pa.int64()),
        "low": pa.array([pa.compute.min(parts.column("low")).as_py()], pa.float64()),
        "high": pa.array([pa.compute.max(parts.column("high")).as_py()], pa.float64()), "keys": pa.array([found.tobytes()], pa.binary()),
    })


class FileTable:
    """``keys`` name the columns by which files are laid out and indexed; without them nothing is."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), retry: RetryPolicy = RetryPolicy(first=0.05, total=30.0)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.retry = replace(retry, retry_on=(*retry.retry_on, CommitConflict))
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    # --- log

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _versions(self) -> list[int]:
        log = self._path("log")
        fs = log.getFileSystem(self.conf)
        if not fs.exists(log):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def head(self, number: int | None = None) -> Version:
        """The newest version, or the one asked for; version 0 is the empty table."""
        number = max(self._versions(), default=0) if number is None else number
        if not number:
            return Version()
        path = self._path(f"log/{number:020d}.json")
        stream = path.getFileSystem(self.conf).open(path)
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version.from_json(number, text)

    def _claim(self, version: Version) -> None:
        """Write a version's file, unless there is one of its number."""
        name = f"{version.number:020d}.json"
        draft, final = self._path(f"log/.{name}.{uuid.uuid4().hex}"), self._path(f"log/{name}")
        fs = final.getFileSystem(self.conf)
        fs.mkdirs(final.getParent())
        out = fs.create(draft, False)
        out.write(version.to_json().encode())
        out.close()
        try:
            if fs.getScheme() == "file":  # a link is made whole and never over another file; a rename may be
                files, java_path = self.jvm.java.nio.file.Files, self.jvm.java.nio.file.Path
                files.createLink(java_path.of(final.toUri().getPath(), self._no_names()), java_path.of(draft.toUri().getPath(), self._no_names()))
            else:
                none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf).rename(draft, final, none)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise CommitConflict(f"version {version.number} of {self.path} is taken") from None
            raise
        finally:
            if fs.exists(draft):
                fs.delete(draft, False)

    def _no_names(self):
        return self.spark.sparkContext._gateway.new_array(self.jvm.java.lang.String, 0)

    def commit(self, head: Version, files: Iterable[DataFile], schema: str, batch: str | None) -> Version:
        """The version after ``head``; raises ``CommitConflict`` if ``head`` is the newest no more."""
        batches = head.batches if batch is None else (*head.batches, batch)[-REMEMBERED:]
        version = Version(head.number + 1, schema, tuple(files), batches)
        self._claim(version)
        return version

    # --- data

    def _listed(self, run: str) -> list[str]:
        folder = self._path(f"data/{run}")
        return sorted(s.getPath().getName() for s in folder.getFileSystem(self.conf).listStatus(folder) if s.getPath().getName().startswith("part-"))

    def stage(self, df: DataFrame, level: int = 0, files: int | None = None) -> list[DataFile]:
        """Write rows as files of no version yet; by key ranges, if the table has keys."""
        run = uuid.uuid4().hex
        laid = df.repartitionByRange(files, *self.keys).sortWithinPartitions(*self.keys) if files and self.keys else df
        laid.write.parquet(f"{self.path}/data/{run}")
        staged = [DataFile(f"{run}/{name}", run, level) for name in self._listed(run)]
        if self.keys and staged:
            self._write_index(run, df.schema)
        return staged

    def _key_columns(self, df: DataFrame) -> DataFrame:
        """``h``: hash of the keys, ``at``: the first key as a number, where it has an order as such."""
        lost = F.lit(False)
        for k in self.keys:
            lost = lost | F.col(k).isNull()
        kind, first = df.schema[self.keys[0]].dataType, F.col(self.keys[0])
        at = F.lit(None)
        if isinstance(kind, (NumericType, TimestampType)):
            at = first
        elif isinstance(kind, DateType):
            at = F.unix_date(first)
        return df.withColumns({"h": F.when(~lost, F.xxhash64(*self.keys)), "at": F.when(~lost, at.cast("double"))})

    def _write_index(self, run: str, schema: StructType) -> None:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data/{run}").withColumn("file", F.concat(F.lit(f"{run}/"), F.col("_metadata.file_name")))
        keyed = self._key_columns(rows.select("file", *self.keys)).select("file", "h", "at")
        # the keys stay where they are read: counted first, so that the filters of a file's parts fit together
        counts = keyed.groupBy("file").agg(F.count("h").alias("n"))
        parts = keyed.join(counts.hint("broadcast"), "file").select("file", "h", "at", "n").mapInArrow(_partly_indexed, INDEX)
        parts.groupBy("file").applyInArrow(_put_together, INDEX).write.parquet(f"{self.path}/index/{run}")

    def read(self, version: Version | None = None, files: Sequence[DataFile] | None = None) -> DataFrame:
        """Rows of the head, of another version, or of some files of it."""
        version = version or self.head()
        files = version.files if files is None else files
        if version.schema is None:
            raise ValueError(f"{self.path} has no version yet")
        schema = StructType.fromJson(json.loads(version.schema))
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f.path}" for f in files])

    def append(self, df: DataFrame, batch: str) -> bool:
        """Add rows once: false, and nothing done, if a load of that id is in the table already."""
        if batch in self.head().batches:
            return False
        staged, done = self.stage(df, files=self._files_for(df) if self.keys else None), []

        def add() -> None:
            head = self.head()
            if batch not in head.batches:
                self.commit(head, [*head.files, *staged], head.schema or df.schema.json(), batch)
                done.append(True)

        self.retry.run(add)
        return bool(done)

    def _files_for(self, df: DataFrame) -> int:
        return max(1, -(-df.count() // FILE_ROWS))

    def touched(self, head: Version, delta: DataFrame) -> list[DataFile]:
        """Live files that may hold a key of ``delta``, by their ranges and filters."""
        if not head.files:
            return []
        kinds = StructType.fromJson(json.loads(head.schema))
        typed = delta.select(*[F.col(k).cast(kinds[k].dataType).alias(k) for k in self.keys])
        asked = self._key_columns(typed).select("h", "at").where("h is not null").distinct()
        held = asked.limit(MOST_KEYS + 1).toArrow()
        if len(held) > MOST_KEYS:
            return list(head.files)
        hashes, at = held.column("h").to_numpy(), held.column("at").to_numpy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = []
                for low, high, keys in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    near = hashes if low is None else hashes[(at >= low) & (at <= high)]
                    hit.append(bool(len(near)) and bool(may_hold(keys, near).any()))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit, pa.bool_()))], names=["file"])

        runs = sorted({f.run for f in head.files})
        index = self.spark.read.schema(INDEX).parquet(*[f"{self.path}/index/{r}" for r in runs]).select("file", "low", "high", "keys")
        names = set(index.mapInArrow(run, "file string").toArrow().column("file").to_pylist())  # no more than live files
        return [f for f in head.files if f.path in names]

    def merge(self, delta: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], batch: str | None = None) -> list[DataFile]:
        """``how(rows, delta)`` over the rows of the files that may hold a key of ``delta``.

        All other files stay as they are. Returns the files that were replaced.
        """
        if not self.keys:
            raise ValueError("a table without keys cannot be merged into")
        gone: list[DataFile] = []

        def attempt() -> None:
            head = self.head()
            gone.clear()
            if batch is not None and batch in head.batches:
                return
            old = self.touched(head, delta)
            merged = how(self.read(head, old), delta) if head.schema else delta
            staged = self.stage(merged, files=max(1, len(old)) if head.schema else self._files_for(delta))
            names = {f.path for f in old}
            self.commit(head, [f for f in head.files if f.path not in names] + staged, head.schema or merged.schema.json(), batch)
            gone.extend(old)

        self.retry.run(attempt)
        return gone

    def replace_runs(self, runs: set[str], df: DataFrame, level: int) -> None:
        """Live files of some runs give way to ``df``, written as one run of another level."""
        staged = self.stage(df, level)

        def swap() -> None:
            head = self.head()
            if runs - {f.run for f in head.files}:
                raise ValueError("the runs are live no more")
            self.commit(head, [f for f in head.files if f.run not in runs] + staged, head.schema, None)

        self.retry.run(swap)
