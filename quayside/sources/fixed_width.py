"""Records whose fields sit at fixed positions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.lines import text_lines

# Fixed value: characters an INTEGER takes in a loader layout.
INTEGER_WIDTH = 7


def field_width(loader_type: str) -> int:
    """Width of a loader type: CHAR(n) n, INTEGER seven, DECIMAL(p,s) p + s."""
    kind = loader_type.strip().upper()
    sizes = [int(n) for n in re.findall(r"\d+", kind)]
    if kind.startswith("INTEGER"):
        return INTEGER_WIDTH
    if not sizes:
        raise ValueError(f"no width in {loader_type!r}")
    return sum(sizes) if kind.startswith("DECIMAL") else sizes[0]


def fixed_width_scan(
    spark: SparkSession,
    path,
    layout: Sequence[tuple[str, int]],
    encoding: str = "UTF-8",
    header_rows: int = 0,
    footer_rows: int = 0,
) -> DataFrame:
    """One string column per field, untrimmed, cut at the running sum of the widths."""
    lines = text_lines(spark, path, encoding, None, header_rows, footer_rows)
    starts = accumulate((width for _, width in layout), initial=1)
    return lines.select([
        F.substring("value", start, width).alias(name)
        for start, (name, width) in zip(starts, layout)
    ])


def fixed_width_lines(df: DataFrame, layout: Sequence[tuple[str, int]]) -> DataFrame:
    """Render columns as padded records: one ``value`` column ready for a text sink."""
    return df.select(F.concat(*[
        F.rpad(F.coalesce(F.col(name).cast("string"), F.lit("")), width, " ") for name, width in layout
    ]).alias("value"))


def layout_error(schema_text, layout_text) -> Column:
    """Null when a layout fits its schema, else why not: sizes differ or a width is no number."""
    names = F.size(F.split(F.col(schema_text), ","))
    widths = F.split(F.col(layout_text), ",")
    numeric = F.forall(widths, lambda w: w.rlike(r"^\s*\d+\s*$"))
    return (
        F.when(names != F.size(widths), F.format_string("Mismatch SCHEMA: %d LAYOUT: %d", names, F.size(widths)))
        .when(~numeric, F.lit("LAYOUT is not a list of whole numbers"))
    )
