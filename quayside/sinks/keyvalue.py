"""Key-value tables: item modes, key schema and the options handed to the connector."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

# Options passed on, capacity of a new table, region without a setting.
PASSED_ON = ("region", "roleArn", "writeBatchSize", "targetCapacity", "throughput", "inferSchema", "endpoint")
READ_UNITS = WRITE_UNITS = 10
DEFAULT_REGION = "us-west-2"
MODES = ("overwrite", "upsert", "insert")


@dataclass(frozen=True)
class Key:
    name: str
    role: str
    type: str


def parse_key_schema(text: str) -> list[Key]:
    """``"customer:HASH:S,salary:RANGE:N"``: one hash key first, at most one range key."""
    keys = [Key(*[p.strip() for p in part.split(":")]) for part in text.split(",")]
    if [k.role for k in keys] not in (["HASH"], ["HASH", "RANGE"]) or any(k.type not in "SNB" for k in keys):
        raise ValueError(f"key schema {text!r} is not name:HASH:type[,name:RANGE:type]")
    return keys


def connector_options(settings: Mapping[str, str]) -> dict[str, str]:
    return {k: settings[k] for k in PASSED_ON if settings.get(k) is not None}


@dataclass
class KeyValueTarget:
    """A table behind a Spark connector; ``create`` and ``truncate`` act on the service."""

    table: str
    settings: Mapping[str, str]
    key_schema: str
    mode: str = "overwrite"
    exists: bool = False
    format: str = "dynamodb"
    create: Callable[[str, list[Key], int, int], None] | None = None
    truncate: Callable[[str, list[Key]], None] | None = None

    def write(self, df: DataFrame) -> None:
        mode = self.mode.lower()
        if mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {', '.join(MODES)}")
        keys = parse_key_schema(self.key_schema)
        missing = [k.name for k in keys if k.name not in df.columns]
        if missing:
            raise ValueError(f"key columns {missing} are missing")
        if mode == "overwrite" and self.exists:
            self.truncate(self.table, keys)
        elif mode == "overwrite":
            units = [int(self.settings.get(n, d)) for n, d in (
                ("ReadCapacityUnits", READ_UNITS), ("WriteCapacityUnits", WRITE_UNITS))]
            self.create(self.table, keys, *units)
        options = {"tableName": self.table, **connector_options(self.settings)}
        if mode == "upsert":
            options["update"] = "true"
        df.write.format(self.format).mode("append").options(**options).save()
