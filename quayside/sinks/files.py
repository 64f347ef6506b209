"""File targets, and the plan for putting processed files away."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.sources.columnar import FORMATS


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", partition_by: Sequence[str] = (), **options) -> None:
    """Write a storage format. Partition folders are filled by tasks balanced on their real sizes,
    so a folder with a third of the rows is written by many of them."""
    kind = fmt.strip().lower()
    if kind not in FORMATS:
        raise ValueError(f"storage format {fmt!r} is not one of {', '.join(FORMATS)}")
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.format(kind).mode(mode).options(**options).partitionBy(*partition_by).save(path)


def archive_target(base: str, day, job, path="path") -> Column:
    """``<base>/<yyyyMMdd>/<job>/<name>`` for a processed file."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    return F.concat_ws(
        "/", F.lit(base.rstrip("/")), F.date_format(col(day), "yyyyMMdd"), col(job).cast("string"),
        F.substring_index(col(path), "/", -1))


def archive_plan(files: DataFrame, base: str, day: str = "processed_at", job: str = "job_id") -> DataFrame:
    """Where each processed file goes; one row per file."""
    return files.select("path", archive_target(base, day, job).alias("archived")).distinct()


def archive(plan: DataFrame) -> DataFrame:
    """Move files as planned, many at once; returns each file with whether it now lies there.

    A file already moved counts as moved, so a task that runs again does no harm. ``path`` and
    ``archived`` are URIs or plain paths every task reaches.
    """
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for source, target in zip(batch["path"].to_pylist(), batch["archived"].to_pylist()):
                files, src = pa_fs.FileSystem.from_uri(source)
                _, dst = pa_fs.FileSystem.from_uri(target)
                if files.get_file_info(src).type == pa_fs.FileType.File:
                    files.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                    files.move(src, dst)
                done.append(files.get_file_info(dst).type == pa_fs.FileType.File)
            yield pa.RecordBatch.from_arrays(
                [batch["path"], batch["archived"], pa.array(done)], names=["path", "archived", "moved"])

    return plan.select("path", "archived").mapInArrow(move, "path string, archived string, moved boolean")
