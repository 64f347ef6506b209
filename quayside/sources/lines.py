"""Text lines of files, with leading and trailing records taken off per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import saved

_PLACE = ["_file", "_block", "_pos"]


def text_lines(
    spark: SparkSession,
    path,
    encoding: str | None = None,
    record_separator: str | None = None,
    header_rows: int = 0,
    footer_rows: int = 0,
) -> DataFrame:
    """Lines of the files as one ``value`` column; ``.gz`` files are unpacked by the reader.

    Header and footer rows are the first and last records of each file. A file may span many
    splits: its outermost rows are found by a ranked window, which keeps only that many rows per
    task before anything is shuffled, and taken out by an anti join with those few rows. Rows are
    marked once and written to the shared folder: a second scan of the files might be packed
    otherwise and mark them otherwise.
    """
    reader = spark.read
    if encoding:
        reader = reader.option("encoding", encoding)
    if record_separator:
        reader = reader.option("lineSep", record_separator)
    raw = reader.text(path)
    if not header_rows and not footer_rows:
        return raw
    placed = raw.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    placed = saved(placed, "text-lines")
    edges = None
    for count, order in (
        (header_rows, [F.col("_block").asc(), F.col("_pos").asc()]),
        (footer_rows, [F.col("_block").desc(), F.col("_pos").desc()]),
    ):
        if not count:
            continue
        rank = F.row_number().over(Window.partitionBy("_file").orderBy(*order))
        found = placed.select(*_PLACE).withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")
        edges = found if edges is None else edges.unionByName(found)
    return placed.join(edges, _PLACE, "left_anti").select("value")
