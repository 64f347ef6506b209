"""Replays, races and merges of tables with a log of versions."""

import hashlib
import pathlib
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators import load
from quayside.sinks import filetable
from quayside.sinks.filetable import CommitConflict, FileTable


def digests(shared):
    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in pathlib.Path(shared).rglob("part-*.parquet")}


def ranged(spark, path, n=1000, files=10, keys=("k",)):
    table = FileTable(spark, path, list(keys))
    rows = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    table.commit(table.head(), table.stage(rows, files=files), rows.schema.json(), "first")
    return table


def test_same_load_counts_once(spark, shared):
    table = FileTable(spark, f"{shared}/t")
    rows = spark.range(5).withColumn("d", F.lit(1))
    assert load.incremental_append(rows, table, ["id"], 1)
    assert not load.incremental_append(rows, table, ["id"], 1)
    assert load.incremental_append(rows, table, ["id"], 3)
    assert sorted(r["id"] for r in table.read().collect()) == [2, 3, 4, 4]
    assert table.head().number == 2
    assert sorted(r["id"] for r in table.read(table.head(1)).collect()) == [2, 3, 4]


def test_a_taken_version_is_refused_and_tried_again(spark, shared):
    table = FileTable(spark, f"{shared}/t")
    table.append(spark.range(1), "a")
    old = table.head()
    table.append(spark.range(2), "b")
    with pytest.raises(CommitConflict):
        table.commit(old, old.files, old.schema, "c")
    assert table.head().batches == ("a", "b")
    assert not [p for p in pathlib.Path(f"{shared}/t/log").iterdir() if p.name.startswith(".0") and p.suffix != ".crc"]


def test_appends_side_by_side_lose_nothing(spark, shared):
    tables = [FileTable(spark, f"{shared}/t") for _ in range(6)]
    work = [threading.Thread(target=lambda t=t, i=i: [t.append(spark.range(i * 10 + j, i * 10 + j + 1), f"{i}-{j}") for j in range(3)]) for i, t in enumerate(tables)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert sorted(r["id"] for r in tables[0].read().collect()) == sorted(i * 10 + j for i in range(6) for j in range(3))
    assert tables[0].head().number == 18


def test_small_delta_leaves_other_files_as_they_are(spark, shared):
    table = ranged(spark, f"{shared}/t")
    before = digests(f"{shared}/t/data")
    delta = spark.createDataFrame([(5, "five"), (7, "seven"), (950, None), (5000, "new"), (None, "none")], "k long, v string")
    gone = table.merge(delta, lambda old, new: load.merge_scd1(old, new, ["k"]), "m1")
    assert len(gone) == 2 and len(before) == 10
    after = digests(f"{shared}/t/data")
    assert all(after[name] == digest for name, digest in before.items())
    live = {f.path for f in table.head().files}
    assert sum(any(path.endswith(name) for path in live) for name in before) == 8
    want = {k: f"v{k}" for k in range(1000)} | {5: "five", 7: "seven", 950: None, 5000: "new"}
    got = table.read().collect()
    assert {r["k"]: r["v"] for r in got if r["k"] is not None} == want and len(got) == 1002
    assert table.merge(delta, lambda old, new: load.merge_scd1(old, new, ["k"]), "m1") == []
    assert table.read().count() == 1002


def test_history_of_other_keys_is_not_rewritten(spark, shared):
    table = FileTable(spark, f"{shared}/h", ["k"])
    history = spark.range(300).selectExpr("id AS k", "'a' AS v", "date'2020-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to", "true AS is_current")
    table.commit(table.head(), table.stage(history, files=6), history.schema.json(), "first")
    delta = spark.createDataFrame([(10, "b"), (11, "a")], "k long, v string").withColumn("at", F.expr("date'2021-01-01'"))
    want = sorted(map(str, load.merge_scd2(history, delta, ["k"], "at").collect()))
    gone = table.merge(delta, lambda old, new: load.merge_scd2(old, new, ["k"], "at"))
    assert len(gone) == 1
    assert sorted(map(str, table.read().collect())) == want


def test_large_delta_and_text_keys(spark, shared, monkeypatch):
    table = FileTable(spark, f"{shared}/t", ["a", "b"])
    rows = spark.range(400).selectExpr("concat('x', id % 20) AS a", "id AS b", "'old' AS v")
    table.commit(table.head(), table.stage(rows, files=8), rows.schema.json(), "first")
    delta = spark.createDataFrame([("x3", 3, "new"), ("x3", 4, "none there")], "a string, b int, v string")
    head = table.head()
    assert 1 <= len(table.touched(head, delta)) < 8
    monkeypatch.setattr(filetable, "MOST_KEYS", 1)
    assert table.touched(head, delta) == list(head.files)
    typed = delta.withColumn("b", F.col("b").cast("long"))
    table.merge(typed, lambda old, new: load.merge_scd1(old, new, ["a", "b"]))
    got = {(r["a"], r["b"]): r["v"] for r in table.read().collect()}
    assert len(got) == 401 and got["x3", 3] == "new" and got["x3", 4] == "none there"


def test_filter_knows_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    held = filetable.key_filter(keys)
    assert filetable.may_hold(held, keys).all()
    others = rng.integers(-(1 << 63), (1 << 63) - 1, 5000)
    assert filetable.may_hold(held, others).mean() < 0.03
    assert not filetable.may_hold(filetable.key_filter(keys[:0]), others).any()


def test_tables_without_rows_or_keys(spark, shared):
    table = FileTable(spark, f"{shared}/t", ["id"])
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.append(spark.range(0), "none")
    assert table.read().count() == 0
    assert table.merge(spark.range(3), lambda old, new: load.merge_scd1(old, new, ["id"])) in ([], list(table.head(1).files))
    assert table.read().count() == 3
    with pytest.raises(ValueError, match="without keys"):
        FileTable(spark, f"{shared}/t").merge(spark.range(3), load.merge_scd1)


def test_a_file_is_indexed_in_parts_without_holding_its_keys(spark, shared):
    """Files read by several tasks, in batches: the same filter and range as of all keys at once."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        table = FileTable(spark, f"{shared}/t", ["k"])
        rows = spark.range(40_000).select(F.when(F.col("id") % 100 != 7, F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
        table.stage(rows, files=3)
        index = spark.read.option("recursiveFileLookup", True).parquet(f"{shared}/t/index").collect()
        back = spark.read.option("recursiveFileLookup", True).parquet(f"{shared}/t/data").groupBy(F.col("_metadata.file_name").alias("f")).agg(
            F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"), F.collect_list(F.when(F.col("k").isNotNull(), F.xxhash64("k"))).alias("h"))
        want = {r["f"]: (r["n"], r["low"], r["high"], filetable.key_filter(np.array(r["h"], dtype=np.int64))) for r in back.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["file"].split("/")[1]: (r["rows"], r["low"], r["high"], bytes(r["keys"])) for r in index} == want


def test_a_task_that_indexes_holds_no_file():
    """What one task keeps while a million keys pass is a filter, not the keys."""
    import tracemalloc

    import pyarrow as pa

    n, size = 1_000_000, 10_000

    def batches():
        for i in range(0, n, size):
            h = np.arange(i, i + size, dtype=np.int64) * 0x9E3779B97F4A7C1
            yield pa.RecordBatch.from_arrays([pa.array(["f"] * size), pa.array(h), pa.array(h.astype(float)), pa.array([n] * size, pa.int64())], names=["file", "h", "at", "n"])

    tracemalloc.start()
    out = list(filetable._partly_indexed(batches()))
    assert len(out) == 1 and out[0].column(1)[0].as_py() == n
    assert tracemalloc.get_traced_memory()[1] < 24e6
    tracemalloc.stop()
