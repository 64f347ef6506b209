"""Sinks against recorders: what is sent, in which order, in which mode. No service is started."""

import json

import pytest
from pyspark.sql import types as T

from quayside.sinks import dialects as d
from quayside.sinks import document, files, jdbc, keyvalue, messages, partitioned

MATRIX = (
    T.StructType().add("id", "integer").add("string_col", "string").add("long_col", "long").add("float_col", "float")
    .add("decimal_col", "decimal(38,8)").add("double_col", "double").add("date_col", "date")
    .add("timestamp_col", "timestamp").add("boolean_col", "boolean"))


class Recorder:
    def __init__(self, existing=()):
        self.log, self.existing = [], set(existing)

    def target(self, dialect=d.VERTICA, **settings):
        return jdbc.JdbcTarget(
            dialect, "main", "t", lambda s: self.log.append(s), lambda n: n in self.existing,
            lambda df, n, o: self.log.append(("save", n, df.columns, dict(o))), **settings)


def saves(log):
    return [e[1] for e in log if isinstance(e, tuple)]


@pytest.mark.parametrize("staging", [None, "stage"])
@pytest.mark.parametrize("managed", [False, True])
@pytest.mark.parametrize("mode", ["overwrite", "append", "merge"])
def test_mode_matrix(spark, mode, managed, staging):
    rec = Recorder(["main.t"])
    df = spark.createDataFrame([], MATRIX)
    rec.target(mode=mode, user_managed=managed, staging_schema=staging, natural_keys=["id"]).write(df)
    work = staging or "main"
    if mode == "append":
        assert rec.log == [("save", "main.t", df.columns, {})]
    elif mode == "merge":
        assert saves(rec.log) == [f"{work}.t_delta"]
        assert rec.log[-2].startswith(f"MERGE INTO main.t AS T USING {work}.t_delta AS D ON (T.id = D.id)")
        assert rec.log[-1] == f"DROP TABLE IF EXISTS {work}.t_delta"
    elif managed:
        assert rec.log == ["TRUNCATE TABLE main.t", ("save", "main.t", df.columns, {})]
    else:
        assert saves(rec.log) == [f"{work}.t_temp"]
        tail = rec.log[rec.log.index(("save", f"{work}.t_temp", df.columns, {})) + 1:]
        assert "DROP TABLE IF EXISTS main.t" in tail
        assert f"ALTER TABLE {work}.t_temp RENAME TO t" in tail
        assert ("ALTER TABLE stage.t SET SCHEMA main" in tail) == (staging == "stage")


def test_merge_without_keys_is_refused():
    with pytest.raises(ValueError, match="natural keys"):
        Recorder().target(mode="merge")


def test_missing_tables(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="does not exist"):
        Recorder().target(mode="append", user_managed=True).write(df)
    with pytest.raises(ValueError, match="does not exist"):
        Recorder().target(mode="append", create_if_missing=False).write(df)
    rec = Recorder()
    rec.target(mode="merge", natural_keys=["id"]).write(df)
    assert saves(rec.log) == ["main.t"] and not any("DROP" in x for x in rec.log)


@pytest.mark.parametrize("mode", ["append", "merge", "overwrite"])
def test_a_failed_probe_is_no_missing_table(spark, mode):
    """Nothing is sent when the database does not say whether the table is there."""
    rec = Recorder(["main.t"])
    target = rec.target(mode=mode, natural_keys=["id"])

    def exists(_):
        raise TimeoutError("no answer")

    target.exists = exists
    with pytest.raises(TimeoutError):
        target.write(spark.range(1))
    assert rec.log == []


class Catalog:
    """A JDBC catalog that lists some tables by (catalog, schema, name) pattern."""

    def __init__(self, tables):
        self.tables, self.open = tables, 0

    def getSearchStringEscape(self):
        return "!"

    def getTables(self, catalog, schema, table, _):
        hits = [t for t in self.tables if (schema or catalog, table) == t]
        self.open += 1
        outer = self

        class Found:
            def next(self):
                return bool(hits)

            def close(self):
                outer.open -= 1

        return Found()


def test_tables_are_looked_up_in_the_catalog():
    from quayside.sinks.jdbc import listed

    catalog = Catalog([("MAIN", "T!_A"), ("db", "x")])
    assert listed(catalog, "main.t_a") and listed(catalog, "db.x") and not listed(catalog, "main.ta") and not listed(catalog, "db.t")
    assert catalog.open == 0


def test_mysql_tolerates_a_refused_drop(spark):
    rec = Recorder(["main.t"])
    target = rec.target(d.MYSQL, staging_schema="stage")

    def execute(statement):
        rec.log.append(statement)
        if statement == "DROP TABLE IF EXISTS main.t":
            raise RuntimeError("no DROP right")

    target.execute = execute
    target.write(spark.range(1))
    assert rec.log[-1] == "RENAME TABLE stage.t_temp TO main.t"


def test_types_and_ddl():
    sizes = d.TextSizes(varchar={"STRING_COL": 30}, default=200)
    mysql = d.column_types(MATRIX, d.MYSQL, sizes)
    assert mysql["string_col"] == "VARCHAR(30)" and mysql["decimal_col"] == "DECIMAL(38,8)" and mysql["id"] == "INT"
    assert d.column_types(MATRIX, d.MYSQL)["string_col"] == "LONGTEXT"
    assert d.column_types(MATRIX, d.MYSQL, d.TextSizes(all_long=True))["string_col"] == "TEXT"
    vertica = d.column_types(MATRIX, d.VERTICA, d.TextSizes(long={"STRING_COL": 9000}))
    assert vertica["string_col"] == "LONG VARCHAR(9000)" and vertica["double_col"] == "DOUBLE PRECISION"
    assert d.column_types(MATRIX, d.VERTICA)["string_col"] == "VARCHAR"
    spanner = d.column_types(MATRIX, d.SPANNER)
    assert (spanner["decimal_col"], spanner["float_col"], spanner["string_col"]) == ("NUMERIC", "FLOAT64", "STRING(MAX)")
    assert d.create_table("s.t", {"a": "INT64"}, d.SPANNER, ["a"]) == "CREATE TABLE s.t (`a` INT64) PRIMARY KEY (a)"
    assert d.create_table("s.t", {"a": "INT"}, d.VERTICA, partition_by="YEAR(a)") == "CREATE TABLE s.t (a INT) PARTITION BY YEAR(a)"
    assert d.create_schema("s", d.MYSQL) == "CREATE DATABASE IF NOT EXISTS s"


def test_merge_text():
    assert d.merge_statement("m.t", "m.x", ["id", "v"], [], d.MYSQL) == (
        "INSERT INTO m.t (id, v) SELECT id, v FROM m.x ON DUPLICATE KEY UPDATE id = VALUES(id), v = VALUES(v)")
    assert d.merge_statement("m.t", "m.x", ["id", "v"], ["id"], d.VERTICA) == (
        "MERGE INTO m.t AS T USING m.x AS D ON (T.id = D.id) WHEN MATCHED THEN UPDATE SET id = D.id, v = D.v "
        "WHEN NOT MATCHED THEN INSERT (id, v) VALUES (D.id, D.v)")


def test_write_options():
    assert d.write_options("numPartitions=2;batchsize=10000;bad;url=a=b") == {"numPartitions": "2", "batchsize": "10000", "url": "a=b"}
    assert d.index_statements("s.t", ["a", "b"], existing=True) == ["DROP INDEX idx_t_a_b", "CREATE INDEX idx_t_a_b ON s.t (a, b)"]


class Memory:
    """Upserts by id into a folder; the first try of some batches fails."""

    def __init__(self, folder, fail):
        self.folder, self.fail = folder, fail

    def upsert(self, rows):
        if self.fail and rows[0]["id"] % 2 == 0 and not hasattr(self, "failed"):
            self.failed = True
            raise partitioned.TransientError("busy")
        import os

        for r in rows:
            with open(os.path.join(self.folder, str(r["id"])), "w") as out:
                out.write(json.dumps(r))

    def close(self):
        pass


@pytest.mark.parametrize("fail", [False, True])
def test_upsert_batches(spark, shared, fail):
    import os

    quick = partitioned.RetryPolicy(first=0.001, total=0.1)
    sent = partitioned.upsert(spark.range(101).selectExpr("id", "id * 2 AS v"), lambda: Memory(shared, fail), batch=10, partitions=3, retry=quick)
    assert sent["rows"] == 101 and sent["largest"] <= 10 and sent["tasks"] == 3 and sent["batches"] >= 11
    assert sorted(map(int, os.listdir(shared))) == list(range(101))


def test_batch_respects_the_mutation_limit():
    assert partitioned.batch_rows(10) == 10000 and partitioned.batch_rows(10, 50) == 50
    assert partitioned.batch_rows(10, cells=40_000) == 3999 and partitioned.batch_rows(2, cells=40_000) == 10000
    assert partitioned.batch_rows(10, 3999, 40_000) == 3999
    for wanted, cells in ((4000, 40_000), (None, 10)):
        with pytest.raises(ValueError, match="more than a commit"):
            partitioned.batch_rows(10, wanted, cells)


def test_retry_policy():
    policy, waits = partitioned.RetryPolicy(), []
    delays = list(policy.delays())
    assert delays[:3] == [0.5, 0.75, 1.125] and sum(delays) <= 60 and max(delays) <= 64

    def fails():
        raise partitioned.TransientError

    with pytest.raises(partitioned.TransientError):
        policy.run(fails, sleep=waits.append)
    assert len(waits) == len(delays)
    with pytest.raises(KeyError):
        policy.run(lambda: {}["x"], sleep=waits.append)
    assert len(waits) == len(delays)


def test_spread(spark):
    df = spark.range(0, 100, 1, 4)
    assert partitioned.spread(df, 2, coalesce=True).rdd.getNumPartitions() == 2
    assert partitioned.spread(df, 9).rdd.getNumPartitions() == 9
    assert partitioned.spread(df, None) is df


def test_document_merge(spark):
    cur = spark.createDataFrame([("i1", 1, "old"), ("i2", 2, "old")], "_id string, k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new"), (None, "n")], "k int, v string")
    updates, inserts = document.split_merge(new, cur, ["k"])
    assert [tuple(r) for r in updates.collect()] == [("i2", 2, "new")]
    assert sorted(str(r.k) for r in inserts.collect()) == ["3", "None"]
    with pytest.raises(ValueError):
        document.split_merge(new, cur, [])


def test_document_modes(spark, shared):
    indexed = []
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    document.DocumentTarget({"path": f"{shared}/c"}, "json", index=["k"], create_index=indexed.append).write(rows)
    document.DocumentTarget({"path": f"{shared}/c"}, "json", "append").write(rows)
    assert spark.read.json(f"{shared}/c").count() == 2 and indexed == [["k"]]
    with pytest.raises(ValueError):
        document.DocumentTarget({}, "json", "upsert").write(rows)


def test_key_value_modes(spark, shared):
    keys = keyvalue.parse_key_schema("customer:HASH:S,salary:RANGE:N")
    assert [(k.name, k.role, k.type) for k in keys] == [("customer", "HASH", "S"), ("salary", "RANGE", "N")]
    for bad in ("a:RANGE:S", "a:HASH", "a:HASH:S,b:HASH:S", "a:HASH:X"):
        with pytest.raises((ValueError, TypeError)):
            keyvalue.parse_key_schema(bad)
    assert keyvalue.connector_options({"region": "r", "mode": "x", "endpoint": "e"}) == {"region": "r", "endpoint": "e"}
    made = []
    rows = spark.createDataFrame([("c", 1)], "customer string, salary int")
    target = keyvalue.KeyValueTarget(
        "t", {"path": shared}, "customer:HASH:S,salary:RANGE:N", format="noop", create=lambda *a: made.append(a[0::2]))
    target.write(rows)
    assert made == [("t", 10)]
    with pytest.raises(ValueError, match="missing"):
        target.write(rows.drop("salary"))


def test_messages(spark, shared):
    rows = spark.createDataFrame([(1, None), (2, "b")], "id int, v string")
    out = messages.message_rows(rows, partition_key="id % 2")
    assert [tuple(r) for r in out.collect()] == [('{"id":1}', "1"), ('{"id":2,"v":"b"}', "0")]
    with pytest.raises(ValueError):
        messages.message_rows(rows, "id", "id")
    assert messages.publish(out, "parquet", {"path": f"{shared}/m"}) == 2


def test_hot_partition_folder_is_written_by_several_tasks(spark, shared):
    import pathlib

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, 'hot', concat('c', id % 50)) AS p", "sha1(cast(id AS STRING)) AS x")
        files.write_files(df, f"{shared}/w", partition_by=["p"])
        assert len(list(pathlib.Path(f"{shared}/w/p=hot").glob("*.parquet"))) > 1
        assert spark.read.parquet(f"{shared}/w").count() == 60000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_types_read_back():
    assert d.read_type(d.SPANNER, d.JDBC_NUMERIC) == T.DecimalType(38, 9)
    assert d.read_type(d.VERTICA, d.JDBC_REAL) == T.FloatType() and d.read_type(d.VERTICA, d.JDBC_OTHER) == T.StringType()
    assert d.read_type(d.VERTICA, d.JDBC_BIT, "bit", 8) == T.BinaryType() and d.read_type(d.MYSQL, d.JDBC_REAL) is None


def test_archive_moves_once(spark, shared):
    import pathlib

    folder = pathlib.Path(shared)
    for n in range(5):
        (folder / f"f{n}.csv").write_text(str(n))
    rows = [(f"{shared}/f{n}.csv", "2024-01-02", "j1") for n in range(6)]
    listed = spark.createDataFrame(rows, "path string, processed_at string, job_id string")
    plan = files.archive_plan(listed, f"{shared}/done")
    for _ in range(2):
        out = {r.path: r.moved for r in files.archive(plan).collect()}
        assert out == {f"{shared}/f{n}.csv": n < 5 for n in range(6)}
    assert sorted(p.name for p in (folder / "done/20240102/j1").iterdir()) == [f"f{n}.csv" for n in range(5)]


def test_task_code_travels_without_the_package():
    import subprocess
    import sys

    from pyspark import cloudpickle

    sent = cloudpickle.dumps(lambda n: list(partitioned.RetryPolicy().delays())[:n])
    read = "import sys; from pyspark import cloudpickle; print(cloudpickle.loads(sys.stdin.buffer.read())(2))"
    out = subprocess.run([sys.executable, "-c", read], input=sent, capture_output=True, cwd="/", timeout=60)
    assert out.stdout.decode().strip().endswith("[0.5, 0.75]"), out.stderr
