"""Streams give what a batch gives, also when a batch runs twice."""

from pyspark.sql import functions as F

from quayside.operators import load
from quayside.operators.schema import ColumnSpec, typed_projection
from quayside.streaming import ingest
from quayside.streaming.levels import LevelledLog

SPECS = [ColumnSpec("id", "bigint"), ColumnSpec("at", "timestamp"), ColumnSpec("v", "int", "val")]


def feed(spark, path, files=4, rows=200):
    df = spark.range(rows).selectExpr(
        "cast(id AS STRING) AS n", "cast(id % 23 AS STRING) AS id",
        "date_format(timestamp_seconds(1700000000 + (id * 7919) % 5000), 'yyyy-MM-dd HH:mm:ss') AS at",
        "IF(id % 10 = 0, 'bad', cast(id AS STRING)) AS val")
    df.repartition(files).write.json(path)
    return path


def test_ingest_equals_batch(spark, shared):
    path = feed(spark, f"{shared}/in")
    typed = ingest.typed_records(ingest.text_stream(spark, path, 1), SPECS)
    ingest.append_to_files(typed, f"{shared}/out", f"{shared}/cp").awaitTermination()
    batch = typed_projection(spark.read.schema("id string, at string, val string").json(path), SPECS, "rejects")
    stream = spark.read.parquet(f"{shared}/out")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
    assert stream.where("array_contains(rejects, 'v')").count() == 20
    ingest.append_to_files(typed, f"{shared}/out", f"{shared}/cp").awaitTermination()
    assert spark.read.parquet(f"{shared}/out").count() == 200


def test_upsert_log_survives_a_replay(spark, shared):
    path = feed(spark, f"{shared}/in")
    typed = ingest.typed_records(ingest.text_stream(spark, path, 1), SPECS, None)
    order = ["at", "v"]
    ingest.upsert_log(typed, f"{shared}/log", f"{shared}/cp1", ["id"], order).awaitTermination()
    want = sorted(map(str, load.dedup(
        typed_projection(spark.read.schema("id string, at string, val string").json(path), SPECS), ["id"], order).collect()))
    assert sorted(map(str, ingest.current_rows(spark, f"{shared}/log", ["id"], order).collect())) == want
    ingest.upsert_log(typed, f"{shared}/log", f"{shared}/cp2", ["id"], order).awaitTermination()
    assert sorted(map(str, ingest.current_rows(spark, f"{shared}/log", ["id"], order).collect())) == want
    ingest.compact(spark, f"{shared}/log", ["id"], order)
    assert sorted(map(str, ingest.current_rows(spark, f"{shared}/log", ["id"], order).collect())) == want
    log = LevelledLog(spark, f"{shared}/log", ["id"], order)
    assert log.table.read().count() == 23 and len(log.table.head().files) >= 1


def test_levels_bound_what_a_reader_folds(spark, shared):
    """Forty batches, some sent again, some that replace rows of old ones."""
    log = LevelledLog(spark, f"{shared}/log", ["id"], ["at"], fan=3)
    want = {}
    for n in range(40):
        rows = [(k, n, f"{n}-{k}") for k in range(n % 7, n % 7 + 5)] + [(100 + n, 0, "own")]
        assert log.add(spark.createDataFrame(rows, "id long, at long, v string"), f"b{n}")
        want.update({k: (k, at, v) for k, at, v in rows})
        if n % 9 == 0:
            assert not log.add(spark.createDataFrame([(1, 99, "again")], "id long, at long, v string"), f"b{n}")
        assert all(len(names) < 3 for names in log.runs().values())
    assert max(log.runs()) >= 3
    assert sorted(map(tuple, log.rows().collect())) == sorted(want.values())


def test_later_of_equal_rows_wins_over_levels(spark, shared):
    log = LevelledLog(spark, f"{shared}/log", ["id"], ["at"], fan=2)
    for n in range(5):
        log.add(spark.createDataFrame([(1, 0, f"v{n}"), (2, -n, f"w{n}")], "id long, at long, v string"), str(n))
    assert {r["id"]: r["v"] for r in log.rows().collect()} == {1: "v4", 2: "w0"}


def test_gate_waits_for_markers(spark, shared):
    import pathlib

    folder = pathlib.Path(shared) / "landing"
    folder.mkdir()
    for name in ("a1.dat", "a2.dat", "b1.dat", "a1.done", "b1.done"):
        (folder / name).write_text("x")
    args = (f"{shared}/log", f"{shared}/ready", f"{shared}/cp", {"ta": r"/a\d\.dat$", "tb": r"/b\d\.dat$"}, ".dat", ".done")
    ingest.gate_arrivals(ingest.arrivals(spark, str(folder), 2), *args).awaitTermination()
    verdict = {r.table_name: r.ready for r in ingest.latest_verdict(spark, f"{shared}/ready").collect()}
    assert verdict == {"ta": False, "tb": True}
    (folder / "a2.done").write_text("x")
    ingest.gate_arrivals(ingest.arrivals(spark, str(folder), 2), *args).awaitTermination()
    verdict = {r.table_name: r.ready for r in ingest.latest_verdict(spark, f"{shared}/ready").collect()}
    assert verdict == {"ta": True, "tb": True}
    assert {r.table_name: r.n_files for r in ingest.latest_verdict(spark, f"{shared}/ready").collect()} == {"ta": 2, "tb": 1}
    for name in ("b2.done", "b2.dat", "a3.dat"):  # a marker ahead of its file, a file without one
        (folder / name).write_text("x")
        ingest.gate_arrivals(ingest.arrivals(spark, str(folder), 2), *args).awaitTermination()
    verdict = {r.table_name: (r.ready, r.n_files, r.n_unmarked) for r in ingest.latest_verdict(spark, f"{shared}/ready").collect()}
    assert verdict == {"ta": (False, 3, 1), "tb": (True, 2, 0)}
    last = max(int(p.name.split("=")[1]) for p in pathlib.Path(f"{shared}/log").iterdir() if "=" in p.name)
    waiting = spark.read.parquet(f"{shared}/log/batch_id={last}").collect()
    assert [r.path.rsplit("/", 1)[1] for r in waiting] == ["a3.dat"]  # only what waits is carried on


def test_replays_are_dropped(spark, shared):
    path = feed(spark, f"{shared}/in")
    rows = ingest.text_stream(spark, path).select(F.from_json("value", "n string, at string").alias("r")).select(
        "r.n", F.col("r.at").cast("timestamp").alias("at"))
    twice = rows.select("n", "at", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    once = ingest.without_replays(twice, ["n"], "at", "2 hours")
    ingest.append_to_files(once, f"{shared}/out", f"{shared}/cp").awaitTermination()
    assert spark.read.parquet(f"{shared}/out").count() == 200


def test_publish_resumes(spark, shared):
    path = feed(spark, f"{shared}/in")
    typed = ingest.typed_records(ingest.text_stream(spark, path, 2), SPECS, None)
    for _ in range(2):
        ingest.publish_stream(typed, "parquet", {"path": f"{shared}/out"}, f"{shared}/cp", "id").awaitTermination()
    sent = spark.read.parquet(f"{shared}/out")
    assert sent.count() == 200 and set(sent.columns) == {"value", "partitionKey"}


def test_source_files_are_archived(spark, shared):
    import pathlib

    feed(spark, f"{shared}/in", files=2)
    lines = ingest.text_stream(spark, f"{shared}/in", 1, archive_to=f"{shared}/kept")
    for _ in range(2):
        ingest.append_to_files(lines, f"{shared}/out", f"{shared}/cp").awaitTermination()
        feed_more = spark.range(1).selectExpr("'x' AS value")
        feed_more.write.mode("append").text(f"{shared}/in")
    assert list(pathlib.Path(f"{shared}/kept").rglob("*.json"))
    assert spark.read.parquet(f"{shared}/out").count() == 201


def test_batches_do_not_grow_with_the_files_that_wait(spark, shared):
    import pathlib

    feed(spark, f"{shared}/in", files=120, rows=240)
    lines = ingest.text_stream(spark, f"{shared}/in", 2)
    ingest.append_to_files(lines, f"{shared}/out", f"{shared}/cp").awaitTermination()
    done = [p for p in pathlib.Path(f"{shared}/cp/commits").iterdir() if p.name.isdigit()]
    assert 1 < len(done) <= ingest.CATCH_UP and spark.read.parquet(f"{shared}/out").count() == 240
