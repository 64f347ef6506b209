"""Rows as messages: a JSON body and, if wanted, the partition they go to."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def message_rows(df: DataFrame, partition_key: str | None = None, partition_id: str | None = None, body: str = "value") -> DataFrame:
    """Body of all columns, null fields left out, and a key or partition number by expression."""
    if partition_key and partition_id:
        raise ValueError("a message has a partition key or a partition id, not both")
    columns = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(body)]
    if partition_key:
        columns.append(F.expr(partition_key).cast("string").alias("partitionKey"))
    if partition_id:
        columns.append(F.expr(partition_id).cast("string").alias("partitionId"))
    return df.select(columns)


def publish(messages: DataFrame, fmt: str, options: Mapping[str, str]) -> int:
    """Send the messages; the number sent is counted on the way, not by a second scan."""
    seen = Observation()
    counted = messages.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).mode("append").options(**options).save()
    return seen.get["n"]
