"""Choosing files from a listing, a DataFrame of ``path`` and ``modified``."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import saved

# Files never taken, optional compression suffix, and the archive folder swap.
EXCLUDED = "(.*done_bkp.*|.*done_backup.*|.*_bkp)"
OPTIONAL_GZ = "(.gz)?"
LIVE_FOLDER, ARCHIVE_FOLDER = "/files/", "/files_archive/"


def list_files(spark: SparkSession, folder: str, sub_folders: bool = False) -> DataFrame:
    """Files of a folder with their times; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", sub_folders).load(folder)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def walk_files(spark: SparkSession, folder: str, depth: int | None = None) -> DataFrame:
    """The files of a folder tree as in ``list_files``, listed by the executors.

    A round lists all folders found in the one before, a folder a row; only their number comes back
    to the driver, which holds no list of files. Every round is written to the shared folder. Hidden
    names (with ``.`` or ``_`` ahead) are left out. Paths are those of pyarrow.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                plain = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
                system, root = fs.FileSystem.from_uri(plain)
                found = [i for i in system.get_file_info(fs.FileSelector(root)) if not i.base_name.startswith(".") and (not i.base_name.startswith("_") or "=" in i.base_name)]
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([f"{uri.rstrip('/')}/{i.base_name}" for i in found], pa.string()), "modified": pa.array([i.mtime for i in found], pa.timestamp("us", "UTC")),
                    "length": pa.array([i.size for i in found], pa.int64()), "is_folder": pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_())})

    whole = spark.range(1).select(F.lit(folder.rstrip("/")).alias("path"))
    rounds, n = [], 1
    while n and (depth is None or len(rounds) <= depth):
        tasks = min(n, spark.sparkContext.defaultParallelism * 4)
        found = saved(whole.repartition(tasks, "path").mapInArrow(listed, "path string, modified timestamp, length long, is_folder boolean"), "listing")
        rounds.append(found.where("not is_folder").drop("is_folder"))
        whole = found.where("is_folder").select("path")
        n = whole.count()
    files = rounds[0]
    for more in rounds[1:]:
        files = files.unionByName(more)
    return files


def base_name(path="path") -> Column:
    return F.substring_index(F.col(path) if isinstance(path, str) else path, "/", -1)


def glob_to_regex(pattern: str) -> str:
    """File glob to an anchored regular expression."""
    steps = {"*": ".*", "?": "."}
    return "^" + "".join(steps.get(ch) or re.escape(ch) for ch in pattern) + "$"


def archive_path(path="path") -> Column:
    return F.replace(F.col(path) if isinstance(path, str) else path, F.lit(LIVE_FOLDER), F.lit(ARCHIVE_FOLDER))


def select_files(
    listing: DataFrame, include: str = ".*", exclude: str | None = EXCLUDED, allow_gz: bool = False
) -> DataFrame:
    """Files whose whole name matches ``include`` and does not match ``exclude``."""
    name = base_name()
    wanted = listing.where(name.rlike(f"^(?:{include}){OPTIONAL_GZ if allow_gz else ''}$"))
    return wanted.where(~name.rlike(f"^(?:{exclude})$")) if exclude else wanted


def files_after(listing: DataFrame, last=None) -> DataFrame:
    """Files modified after the last seen time (to the second), or all without one."""
    if last is None:
        return listing
    return listing.where(F.col("modified") >= F.lit(last).cast("timestamp") + F.expr("interval 1 second"))


def newest_file(listing: DataFrame, *by: str) -> DataFrame:
    """Newest file per group (or overall); ties go to the greater path. One aggregate, no sort."""
    newest = F.max_by("path", F.struct("modified", "path"))
    return listing.groupBy(*by).agg(newest.alias("path"), F.max("modified").alias("modified"))


def files_for_date(listing: DataFrame, day: str) -> DataFrame:
    """Files whose name holds the date text."""
    return listing.where(F.contains(base_name(), F.lit(day)))


def with_table(listing: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """One row per file and table whose pattern its path matches; patterns are a small spec."""
    hits = [F.when(F.col("path").rlike(p), F.lit(t)) for t, p in patterns.items()]
    return listing.withColumn("table_name", F.explode(F.array_compact(F.array(*hits))))


def marker_of(path: str, suffix: str, marker_suffix: str) -> Column:
    return F.concat(F.replace(F.col(path), F.lit(suffix), F.lit("")), F.lit(marker_suffix))


def ready_tables(files: DataFrame, listing: DataFrame, suffix: str, marker_suffix: str) -> DataFrame:
    """Per table: number of data files, files without a marker, and whether it may be loaded.

    ``files`` has ``table_name`` and ``path``. The marker of a file is its path with ``suffix``
    taken out and ``marker_suffix`` put at the end.
    """
    markers = listing.where(F.endswith(F.col("path"), F.lit(marker_suffix)))
    markers = markers.select(F.col("path").alias("_marker")).distinct()
    checked = files.withColumn("_want", marker_of("path", suffix, marker_suffix)).join(markers, F.col("_want") == F.col("_marker"), "left")
    return checked.groupBy("table_name").agg(
        F.count("*").alias("n_files"),
        F.count_if(F.col("_marker").isNull()).alias("n_unmarked"),
        F.bool_and(F.col("_marker").isNotNull()).alias("ready"),
    )
