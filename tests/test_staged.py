"""A job's rows are seen all at once or not at all."""

import pathlib

import pytest
from pyspark.sql import functions as F

from quayside.sinks import staged


def put(df, path, mode="append", fmt="keyed_folder", **options):
    df.write.format(fmt).mode(mode).options(path=path, **options).save()


@pytest.fixture
def registered(spark):
    staged.register(spark)
    return spark


def attempts(path):
    folder = pathlib.Path(path) / "staged"
    return sorted(p.name for p in folder.iterdir()) if folder.is_dir() else []


def test_rows_come_in_batches_of_one_commit(registered, shared):
    df = registered.range(1003).selectExpr("id", "cast(id AS STRING) AS v").repartition(3)
    put(df, f"{shared}/t", batch=100)
    told = staged.receipts(registered, f"{shared}/t").collect()
    assert len(told) == 1 and (told[0]["rows"], told[0]["largest"]) == (1003, 100) and 11 <= told[0]["batches"] <= 13
    assert sorted(r["id"] for r in staged.committed(registered, f"{shared}/t").collect()) == list(range(1003))


def test_a_later_job_wins_by_key_and_overwrite_replaces(registered, shared):
    path = f"{shared}/t"
    put(registered.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, keys="k")
    put(registered.createDataFrame([(2, "c"), (3, None)], "k int, v string"), path, keys="k")
    assert {tuple(r) for r in staged.current(registered, path, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, None)}
    put(registered.createDataFrame([(9, "z")], "k int, v string"), path, "overwrite", keys="k")
    assert [tuple(r) for r in staged.current(registered, path, ["k"]).collect()] == [(9, "z")]
    for target in (path, f"{shared}/new"):
        put(registered.createDataFrame([], "k int, v string"), target, "overwrite", keys="k")
        assert staged.current(registered, target, ["k"]).collect() == []


def test_a_failed_job_leaves_nothing(registered, shared):
    path = f"{shared}/t"
    put(registered.range(10), path)
    before = attempts(path)
    bad = registered.range(0, 400, 1, 4).select(F.when(F.col("id") == 350, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        put(bad, path, batch=10)
    assert staged.committed(registered, path).count() == 10
    staged.vacuum(registered, path, hours=0)  # a task that was killed may have been writing still
    assert attempts(path) == before


def test_abort_discards_all_attempts_of_the_job(registered, shared):
    path = f"{shared}/t"
    put(registered.range(10), path)
    before = attempts(path)
    writer = staged.StagedWriter(staged.FolderService, registered.range(1).schema, {"path": path}, False)
    service = staged.FolderService({"path": path})
    for attempt in (f"{writer.job}-0", f"{writer.job}-1"):
        service.stage(attempt, 0, registered.range(3).toArrow())
    writer.abort([None, None])
    assert attempts(path) == before


def test_what_a_dead_task_left_is_not_read(registered, shared):
    path = f"{shared}/t"
    put(registered.range(5), path)
    registered.range(100, 105).write.parquet(f"{path}/staged/dead-attempt")
    (pathlib.Path(path) / "staged" / "half").mkdir()
    (pathlib.Path(path) / "staged" / "half" / ".000000.parquet.x").write_bytes(b"half a file")
    assert sorted(r["id"] for r in staged.committed(registered, path).collect()) == [0, 1, 2, 3, 4]


class Flaky(staged.FolderService):
    """Refuses the first try of every batch and of the commit, some after doing it."""

    tries = 0

    def stage(self, attempt, number, rows):
        self.tries += 1
        if self.tries % 2:
            if self.tries % 4 == 1:
                super().stage(attempt, number, rows)
            raise TimeoutError("busy")
        super().stage(attempt, number, rows)

    def commit(self, receipt):
        self.tries += 1
        if self.tries == 1:
            super().commit(receipt)
            raise ConnectionError("gone")
        super().commit(receipt)


def test_refused_batches_are_sent_again(spark, shared):
    spark.dataSource.register(staged.service_format("flaky_folder", Flaky))
    put(spark.range(200).repartition(2), f"{shared}/t", fmt="flaky_folder", batch=20, retry_first=0.001, retry_total=1)
    assert sorted(r["id"] for r in staged.committed(spark, f"{shared}/t").collect()) == list(range(200))
    assert staged.receipts(spark, f"{shared}/t").count() == 1
    with pytest.raises(Exception, match="busy"):
        put(spark.range(20), f"{shared}/u", fmt="flaky_folder", batch=20, retry_first=1, retry_total=0.5)
    assert not (pathlib.Path(f"{shared}/u") / "receipts").exists()


def test_options_are_checked(registered, shared):
    with pytest.raises(Exception, match="no such column"):
        put(registered.range(3), f"{shared}/t", keys="nokey")
    with pytest.raises(Exception, match="more than a commit"):
        put(registered.range(3), f"{shared}/t", cells=10, batch=50)
