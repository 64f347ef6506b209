"""Delimited text files, all fields read as strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.lines import text_lines

# What a source without its own settings uses.
DEFAULTS = {"sep": ",", "quote": '"', "escape": "\\", "encoding": "UTF-8"}


def delimiter_from_control(spec: Mapping[str, str], default: str = DEFAULTS["sep"]) -> str:
    """Delimiter named by a loader's control row, if it names one."""
    return (spec.get("delimiter") or "").strip("'\"") or default


def delimited_scan(
    spark: SparkSession,
    path,
    columns: Sequence[str],
    sep: str = DEFAULTS["sep"],
    quote: str = DEFAULTS["quote"],
    escape: str = DEFAULTS["escape"],
    encoding: str = DEFAULTS["encoding"],
    header_rows: int = 0,
    footer_rows: int = 0,
    record_separator: str | None = None,
) -> DataFrame:
    """Read the named columns as text.

    Without footers and with at most one header row this is a plain CSV scan with column pruning.
    Otherwise the outer rows come off first and the remaining lines are parsed in place. Blank
    lines are no records either way.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {"sep": sep, "quote": quote, "escape": escape}
    if header_rows <= 1 and not footer_rows:
        reader = spark.read.schema(schema).options(**options, encoding=encoding, header=header_rows == 1)
        if record_separator:
            reader = reader.option("lineSep", record_separator)
        return reader.csv(path)
    lines = text_lines(spark, path, encoding, record_separator, header_rows, footer_rows)
    lines = lines.where(F.col("value").rlike(r"[^\x00-\x20]"))
    parsed = F.from_csv(F.col("value"), schema.simpleString()[len("struct<"):-1].replace(":", " "), options)
    return lines.select(parsed.alias("row")).select("row.*")
