"""Database and key-value targets with folders in the place of tables.

No database is started: rows go where Spark would write them, and every statement is noted whole.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pytest
from pyarrow import fs as pa_fs
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quayside.operators import load
from quayside.plans.loading import DELTA, TARGET
from quayside.plans.publishing import folder_uri
from quayside.plans.registry import Inputs
from quayside.sinks import dialects, jdbc, keyvalue
from tests.oracle import TESTDATA


class _Folders:
    """Tables as folders; keeps every statement."""

    def __init__(self, t, existing=()):
        self.t, self.base, self.existing, self.sent = t, t.scratch("tables"), set(existing), []

    def target(self, dialect, **settings):
        return jdbc.JdbcTarget(
            dialect, "main", "orders", self.sent.append,
            lambda name: name in self.existing,
            lambda df, name, options: df.write.mode("append").parquet(f"{self.base}/{name}"), **settings)

    def rows(self, name):
        return keys_of(self.t.spark.read.parquet(f"{self.base}/{name}"))


def keys_of(df):
    return sorted(r["k"] for r in df.select("k").collect())


@pytest.fixture
def t(spark):
    return Inputs(spark, f"{TESTDATA}/sf0.001")


def test_overwrite_swaps(t):
    out = _Folders(t, ["main.orders"])
    out.target(dialects.MYSQL, staging_schema="stage", primary_key=["k"], create_schema=True).write(t.sql(TARGET))
    assert out.rows("stage.orders_temp") == keys_of(t.sql(TARGET))
    assert out.sent == [
        "CREATE DATABASE IF NOT EXISTS stage", "DROP TABLE IF EXISTS stage.orders_temp",
        dialects.create_table("stage.orders_temp", dialects.column_types(t.sql(TARGET).schema, dialects.MYSQL), dialects.MYSQL, ["k"]),
        dialects.add_primary_key("stage.orders_temp", ["k"], dialects.MYSQL), "DROP TABLE IF EXISTS stage.orders",
        "DROP TABLE IF EXISTS main.orders", "RENAME TABLE stage.orders_temp TO main.orders",
    ]


def test_truncate_and_load(t):
    out = _Folders(t, ["main.orders"])
    out.target(dialects.VERTICA, user_managed=True).write(t.sql(TARGET))
    assert out.rows("main.orders") == keys_of(t.sql(TARGET)) and out.sent == [dialects.truncate_table("main.orders")]


def test_append(t):
    out = _Folders(t, ["main.orders"])
    for _ in range(2):
        out.target(dialects.VERTICA, mode="append").write(t.sql(TARGET))
    assert out.rows("main.orders") == sorted(2 * keys_of(t.sql(TARGET))) and out.sent == []


def test_merge_by_staging(t):
    """The staged delta has one row per key, as a set-based merge needs."""
    out, delta = _Folders(t, ["main.orders"]), load.dedup(t.sql(DELTA), ["k"], ["seen"])
    out.target(dialects.VERTICA, mode="merge", natural_keys=["k"]).write(delta)
    staged = "main.orders_delta"
    assert out.rows(staged) == keys_of(delta) == sorted(set(keys_of(t.sql(DELTA))))
    assert out.sent == [
        f"DROP TABLE IF EXISTS {staged}", dialects.create_table(staged, dialects.column_types(delta.schema, dialects.VERTICA), dialects.VERTICA),
        dialects.merge_statement("main.orders", staged, delta.columns, ["k"], dialects.VERTICA), f"DROP TABLE IF EXISTS {staged}",
    ]


def test_indexes(t):
    out = _Folders(t)
    out.target(dialects.SPANNER, primary_key=["k"], index=["cust", "status"]).write(t.sql(TARGET))
    assert out.rows("main.orders_temp") == keys_of(t.sql(TARGET))
    assert out.sent[-1] == "CREATE INDEX idx_orders_cust_status ON main.orders (cust, status)" and len(out.sent) == 5


class ItemSource(DataSource):
    """A key-value connector's shape over the shared folder: ``tableName``, ``endpoint``, ``update``."""

    @classmethod
    def name(cls):
        return "folder_items"

    def writer(self, schema, overwrite):
        return ItemWriter(self.options)


@dataclass
class Written(WriterCommitMessage):
    """A file a task has finished but nobody sees yet."""

    partial: str
    final: str


class ItemWriter(DataSourceArrowWriter):
    """Tasks write hidden files; the commit names those of the tasks that counted."""

    def __init__(self, options):
        self.updates = options.get("update", "false")
        self.folder = f"{options['endpoint']}/{options['tableName']}"

    def write(self, batches):
        files, folder = pa_fs.FileSystem.from_uri(self.folder)
        files.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex
        with files.open_output_stream(f"{folder}/.{name}") as out:
            for batch in batches:
                lines = (json.dumps({**row, "updated": self.updates}) + "\n" for row in batch.to_pylist())
                out.write("".join(lines).encode())
        return Written(f"{folder}/.{name}", f"{folder}/{name}.json")

    def commit(self, messages):
        files, _ = pa_fs.FileSystem.from_uri(self.folder)
        for m in messages:
            if m is not None:
                files.move(m.partial, m.final)

    def abort(self, messages):
        files, _ = pa_fs.FileSystem.from_uri(self.folder)
        for m in messages:
            if m is not None:
                files.delete_file(m.partial)


def test_items_are_made_upserted_and_inserted(t):
    """An overwrite that makes the table, an upsert, and an insert."""
    t.spark.dataSource.register(ItemSource)
    settings = {"endpoint": folder_uri(t.scratch("items")), "ReadCapacityUnits": "5", "other": "left out"}
    made = []

    def write(mode, rows):
        keyvalue.KeyValueTarget(
            "items", settings, "id:HASH:N,segment:RANGE:S", mode, format="folder_items",
            create=lambda *args: made.append(args)).write(rows)

    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    orders = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("segment")).distinct()
    for mode, rows in (("overwrite", customers), ("upsert", orders), ("insert", customers)):
        write(mode, rows)
    stored = t.spark.read.schema("id long, segment string, updated string").json(settings["endpoint"] + "/items")
    want = [(*r, flag) for rows, flag in ((customers, "false"), (orders, "true"), (customers, "false")) for r in rows.collect()]
    assert len(made) == 1 and sorted(map(tuple, stored.collect())) == sorted(want)
