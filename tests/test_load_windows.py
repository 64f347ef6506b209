"""Loads and windows against brute force in Python, with one key holding a third of the rows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators import lineage, load, relational, scripts

DAY = dt.datetime(2020, 1, 1)


def skewed(spark, n=600, seed=7):
    rng = random.Random(seed)
    rows = [(i, 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)]), DAY + dt.timedelta(seconds=rng.randrange(40000)),
             rng.choice([None, *range(50)])) for i in range(n)]
    return spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, v int")


def test_dedup_with_a_hot_key(spark):
    df = skewed(spark)
    rows = df.collect()
    for keep, pick in (("latest", max), ("earliest", min)):
        best = {}
        for r in rows:
            best[r.k] = pick(best.get(r.k, r), r, key=lambda x: (x.ts, x.id))
        out = load.dedup(df, ["k"], ["ts", "id"], keep).collect()
        assert {r.k: r.id for r in out} == {k: r.id for k, r in best.items()}
        assert out[0].__fields__ == rows[0].__fields__


def test_merge_scd1_edges(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    delta = spark.createDataFrame([(2, "B"), (3, None), (None, "N")], "k int, v string")
    out = load.merge_scd1(target, delta, ["k"]).collect()
    assert sorted((str(r.k), str(r.v)) for r in out) == [("1", "a"), ("2", "B"), ("3", "None"), ("None", "N"), ("None", "n")]


def scd2_by_hand(history, delta):
    """What each instant shows, by replaying the delta on the list of versions."""
    out = list(history)
    for k, v, at in delta:
        hit = next((h for h in out if h[0] == k and h[2] <= at and (h[3] is None or at < h[3])), None)
        if hit is None:
            later = [h[2] for h in out if h[0] == k and h[2] > at]
            out.append((k, v, at, min(later) if later else None, not later))
        elif hit[1] != v:
            out.remove(hit)
            if hit[2] < at:
                out.append((k, hit[1], hit[2], at, False))
            out.append((k, v, at, hit[3], hit[4]))
    return sorted(out, key=str)


def test_merge_scd2_against_replay(spark):
    rng = random.Random(3)
    day = lambda n: DAY + dt.timedelta(days=n)
    history, delta = [], []
    for k in range(60):
        cuts = sorted(rng.sample(range(100), rng.randrange(1, 5)))
        closed = rng.random() < 0.2
        for i, c in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else (120 if closed else None)
            if rng.random() < 0.15 and end is not None and i + 1 < len(cuts):
                end = c + max(1, (end - c) // 2)
            history.append((k, rng.choice(["x", "y", None]), day(c), None if end is None else day(end), end is None))
        if rng.random() < 0.9:
            delta.append((k, rng.choice(["x", "y", None]), day(rng.choice([*cuts, rng.randrange(-5, 130)]))))
    delta += [(100 + i, "new", day(i)) for i in range(5)]
    h = spark.createDataFrame(history, "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    d = spark.createDataFrame(delta, "k int, v string, at timestamp_ntz")
    out = load.merge_scd2(h, d, ["k"], "at").collect()
    assert sorted(map(tuple, out), key=str) == scd2_by_hand(history, delta)
    again = load.merge_scd2(load.merge_scd2(h, d, ["k"], "at"), d, ["k"], "at").collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_merge_partitions_touches_only_its_own(spark, shared):
    path, staging = f"{shared}/t", f"{shared}/s"
    spark.sql("SELECT * FROM VALUES (1, 'a', 10), (2, 'a', 20), (3, 'b', 30) AS v(k, p, n)").write.partitionBy("p").parquet(path)
    import pathlib

    before = sorted(x.name for x in pathlib.Path(f"{path}/p=b").iterdir())
    delta = spark.sql("SELECT * FROM VALUES (2, 'a', 21), (4, 'c', 40) AS v(k, p, n)")
    load.merge_partitions(spark, path, delta, ["k"], "p", staging)
    out = {r.k: r.n for r in spark.read.parquet(path).collect()}
    assert out == {1: 10, 2: 21, 3: 30, 4: 40}
    assert sorted(x.name for x in pathlib.Path(f"{path}/p=b").iterdir()) == before


def test_full_refresh_leaves_the_old_folder(spark, shared):
    first = load.full_refresh(spark.range(3), "t_refresh_test", shared)
    second = load.full_refresh(spark.table("t_refresh_test").where("id > 0"), "t_refresh_test", shared)
    assert first != second
    assert spark.table("t_refresh_test").count() == 2 and spark.read.parquet(first).count() == 3
    spark.sql("DROP TABLE t_refresh_test")


def test_running_total_equals_plain_window(spark):
    df = skewed(spark)
    plain = F.sum("v").over(Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0))
    want = {r.id: r.t for r in df.withColumn("t", plain).collect()}
    got = relational.running_total(df, ["k"], ["ts", "id"], "v", F.date_trunc("hour", "ts"), "t")
    assert {r.id: r.t for r in got.collect()} == want


def test_rank_equals_plain_window(spark):
    df = skewed(spark)
    plain = F.rank().over(Window.partitionBy("k").orderBy("v"))
    want = {r.id: r.t for r in df.withColumn("t", plain).collect()}
    got = relational.rank_within(df, ["k"], "v", F.floor(F.col("v") / 10), "t")
    assert {r.id: r.t for r in got.collect()} == want


def test_lookback_equals_brute_force(spark):
    df = skewed(spark, 300)
    rows = df.collect()
    want = {r.id: sum(o.v or 0 for o in rows if o.k == r.k and dt.timedelta(0) <= r.ts - o.ts <= dt.timedelta(seconds=900)) for r in rows}
    got = relational.lookback_sum(df, ["k"], "ts", "v", 900, "t")
    assert {r.id: r.t or 0 for r in got.collect()} == want


def test_consecutive_groups_over_stretches(spark):
    rng = random.Random(5)
    rows = [(s, n, rng.choice(["a", "b", None])) for s in ("hot", "cold") for n in range(1, 400 if s == "hot" else 30)]
    want, prev, group = {}, {}, {}
    for s, n, env in rows:
        if s in prev and prev[s] is not None and env != prev[s]:
            group[s] += 1
        group.setdefault(s, 1)
        prev[s] = env
        want[(s, n)] = group[s]
    df = spark.createDataFrame(rows, "script string, n int, env string")
    out = scripts.consecutive_groups(df, "script", "n", "env", stretch=16).collect()
    assert {(r.script, r.n): r.group_no for r in out} == want


def test_update_from(spark):
    t = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (None, 30, "c")], "k int, n int, s string")
    s = spark.createDataFrame([(1, 5), (2, 7), (None, 9)], "k int, add int")
    out = relational.update_from(t, s, ["k"], {"n": "t.n + s.add"}, where="t.s <> 'b'")
    assert sorted((str(r.k), r.n) for r in out.collect()) == [("1", 15), ("2", 20), ("None", 30)]


def test_upstream_walk_ends_on_cycles(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("x", "c"), ("c", "a"), ("d", "d"), ("z", "y"), (None, "b")], "src string, trg string")
    out = lineage.upstream(edges, spark.createDataFrame([("c",), ("d",)], "node string"))
    assert {r.node: r.distance for r in out.collect()} == {"c": 0, "d": 0, "b": 1, "x": 1, "a": 2}


def test_between_dates_prunes_partitions(spark, shared):
    df = load.with_partition(spark.sql("SELECT explode(sequence(DATE'2020-01-01', DATE'2020-12-31')) AS d"), "d", "yyyyMM", "m")
    df.write.partitionBy("m").parquet(f"{shared}/p")
    back = load.between_dates(spark.read.parquet(f"{shared}/p"), "d", "m", "yyyyMM", "2020-02-10", "2020-03-05")
    assert back.count() == 25
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_scd2_with_several_changes_of_a_key(spark):
    """As if they had come one after another; history is shuffled once."""
    import random

    from tests.test_plans import plan

    rng = random.Random(8)
    history, delta = [], []
    for k in range(30):
        at = 0
        for _ in range(rng.randint(0, 4)):
            start, at = at + rng.choice([0, 5]), 0
            at = start + rng.randint(3, 9)
            history.append((k, rng.choice("ab"), rng.choice("xy"), start, at, False))
        if rng.random() < 0.5 and at:
            history.append((k, "a", "x", at, None, True))
        delta += [(k, rng.choice("abc"), rng.choice("xy"), t) for t in rng.sample(range(45), rng.randint(0, 5))]
    delta += [(None, "n", "x", 1), (None, "n", "x", 1)]
    history.append((None, "n", "y", 1, None, True))
    columns = "k int, v string, w string"
    h = spark.createDataFrame(history, f"{columns}, valid_from int, valid_to int, is_current boolean")
    shape = f"{columns}, at int"
    step, first = h, [r for r in delta if r[0] is None]
    for t in range(45):
        rows = [r for r in delta if r[0] is not None and r[3] == t]
        if rows:
            step = spark.createDataFrame(load.merge_scd2(step, spark.createDataFrame(rows, shape), ["k"], "at").collect(), h.schema)
    step = load.merge_scd2(step, spark.createDataFrame(first, shape), ["k"], "at")
    once = load.merge_scd2(h, spark.createDataFrame(delta, shape), ["k"], "at")
    assert plan(once).count("Exchange hashpartitioning") == 1
    assert sorted(map(str, map(tuple, once.collect()))) == sorted(map(str, map(tuple, step.collect())))


def test_scd1_columns_are_overwritten(spark):
    h = spark.createDataFrame([(1, "a", "x", 0, None, True)], "k int, v string, w string, valid_from int, valid_to int, is_current boolean")
    d = spark.createDataFrame([(1, "a", "y", 3), (1, "b", "y", 5), (1, "b", "z", 7)], "k int, v string, w string, at int")
    got = sorted(map(tuple, load.merge_scd2(h, d, ["k"], "at", scd1_columns=["w"]).collect()))
    assert got == [(1, "a", "y", 0, 5, False), (1, "b", "z", 5, None, True)]


def test_scd2_keeps_open_starts_and_versions_without_length(spark):
    """Only a change at a version's own start takes that version away."""
    shape = "k int, v string, valid_from int, valid_to int, is_current boolean"
    history = [(1, "a", None, 5, False), (1, "b", 5, None, True), (2, "z", 3, 3, False), (2, "a", 3, None, True), (3, "z", 4, 4, False)]
    h = spark.createDataFrame(history, shape)

    def merged(*delta):
        d = spark.createDataFrame(delta, "k int, v string, at int")
        return sorted(map(tuple, load.merge_scd2(h, d, ["k"], "at").collect()), key=str)

    def shown(*rows):
        return sorted(rows, key=str)

    assert merged() == shown(*history)
    got = merged((1, "c", 2), (1, "d", 5), (2, "b", 3), (3, "n", 1))
    assert got == shown(
        (1, "a", None, 2, False), (1, "c", 2, 5, False), (1, "d", 5, None, True),
        (2, "z", 3, 3, False), (2, "b", 3, None, True), (3, "n", 1, 4, False), (3, "z", 4, 4, False))
    later = merged((2, "b", 8), (2, "a", 6), (3, "n", 9))
    assert later == shown(
        *history[:3], (2, "a", 3, 8, False), (2, "b", 8, None, True), (3, "z", 4, 4, False), (3, "n", 9, None, True))


def test_tasks_of_a_history_merge_follow_its_rows(spark, monkeypatch):
    import re

    from tests.test_plans import plan

    monkeypatch.setattr(load, "TASK_ROWS", 100, raising=False)
    day = "timestamp_seconds(id * 86400)"
    h = spark.range(2000).selectExpr("id AS k", "'a' AS v", f"{day} AS valid_from", "cast(null AS timestamp) AS valid_to", "true AS is_current")
    d = spark.range(500).selectExpr("id AS k", "'b' AS v", "timestamp_seconds((id + 10) * 86400) AS at")
    merged = load.merge_scd2(h, d, ["k"], "at")
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan(merged)) == ["25"]
    assert merged.count() == 2500 and merged.where("is_current").count() == 2000
