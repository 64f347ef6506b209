"""Storage formats read and written by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The formats a table may be stored in.
FORMATS = ("parquet", "orc", "csv", "json", "avro", "delta")


_NO_CONNECTOR = ("DATA_SOURCE_NOT_FOUND", "Failed to find data source", "Failed to find the data source")


def columnar_scan(
    spark: SparkSession, path, fmt: str = "parquet", columns: Sequence[str] | None = None, schema=None, **options
) -> DataFrame:
    """Scan files of a format; ``columns`` prunes at the scan where the format can.

    With ``schema`` (a type or DDL text) CSV and JSON are read once, without a pass to infer types.
    """
    kind = fmt.strip().lower()
    if kind not in FORMATS:
        raise ValueError(f"storage format {fmt!r} is not one of {', '.join(FORMATS)}")
    try:
        reader = spark.read.format(kind).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
    except Exception as e:
        if any(sign in str(e) for sign in _NO_CONNECTOR):
            raise ValueError(f"format {kind!r} needs its connector on the cluster") from e
        raise
    return df.select(*columns) if columns else df
