"""Copies compared by digests, draws of a number of rows, reads of equal size."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from quayside.operators import load, relational
from quayside.sources import jdbc


def test_digests_know_rows_not_their_order(spark):
    rows = [(i, f"v{i % 7}", None if i % 5 else i * 0.5) for i in range(200)]
    a = spark.createDataFrame(rows, "k int, v string, x double")
    b = spark.createDataFrame(rows[::-1], "k int, v string, x double").repartition(5).select("x", "k", "v")
    assert load.differing(a, b, ["k"], 16) == []
    rows[17] = (17, "other", None)
    changed = spark.createDataFrame(rows, "k int, v string, x double")
    bucket = spark.createDataFrame([(17,)], "k int").select(load.bucket_of(["k"], 16)).first()[0]
    assert load.differing(a, changed, ["k"], 16) == [bucket]
    assert load.differing(a, a.unionByName(a.where("k = 17")), ["k"], 16) == [bucket]
    # two rows that change places with one another's values
    swapped = a.withColumn("v", F.when(F.col("k") == 1, "v2").when(F.col("k") == 2, "v1").otherwise(F.col("v")))
    assert load.differing(a, swapped, ["k"], 16)


def test_copy_follows_its_source(spark, shared):
    path, schema = f"{shared}/copy", "k int, v string"
    first = spark.createDataFrame([(i, "a") for i in range(40)], schema)
    assert load.replicate_into(first, path, ["k"], 8) == sorted(r[0] for r in first.select(load.bucket_of(["k"], 8)).distinct().collect())
    later = spark.createDataFrame([(i, "b" if i == 3 else "a") for i in range(3, 40)], schema)
    assert 1 <= len(load.replicate_into(later, path, ["k"], 8)) <= 4
    assert sorted(map(tuple, spark.read.schema(schema).parquet(path).drop("_bucket").collect())) == sorted(map(tuple, later.collect()))
    only = spark.createDataFrame([(5, "a")], schema)
    load.replicate_into(only, path, ["k"], 8)
    assert [tuple(r) for r in spark.read.schema(schema).parquet(path).drop("_bucket").collect()] == [(5, "a")]
    assert load.replicate_into(only, path, ["k"], 8) == []


def test_drawn_rows(spark):
    df = spark.range(2000).withColumn("v", F.col("id") % 3)
    one = sorted(map(tuple, relational.sample_rows(df, 300, 5).collect()))
    assert len(one) == len(set(one)) == 300
    assert one == sorted(map(tuple, relational.sample_rows(df.repartition(9), 300, 5).collect()))
    assert one != sorted(map(tuple, relational.sample_rows(df, 300, 6).collect()))
    assert 850 < statistics.mean(r[0] for r in one) < 1150
    assert relational.sample_rows(df, 5000).count() == 2000 and relational.sample_rows(df, 0).count() == 0
    same = spark.createDataFrame([(1,)] * 50 + [(2,)] * 50, "k int")
    assert relational.sample_rows(same, 70).count() == 70


@pytest.mark.parametrize("shape", ["square", "hot", "few", "dates", "nulls"])
def test_reads_are_even_and_cover_all(spark, shape):
    rng = random.Random(2)
    values = {
        "square": [i * i for i in range(4000)], "few": [rng.randrange(3) for _ in range(3000)], "nulls": [None] * 5,
        "hot": [9 if rng.random() < 0.6 else rng.randrange(10**6) for _ in range(5000)], "dates": [f"2020-{1 + i % 12:02d}-{1 + (i * i) % 28:02d}" for i in range(3000)],
    }[shape]
    rows = [(v, i if i % 11 else None) for i, v in enumerate([*values, None])]
    df = spark.createDataFrame(rows, "k string, i long" if shape == "dates" else "k long, i long").repartition(4)
    if shape == "dates":
        df = df.withColumn("k", F.col("k").cast("date"))
    texts = jdbc.depth_predicates(df, "k", 8, "i")
    hits = df.select(*[F.coalesce(F.expr(t), F.lit(False)).cast("int").alias(f"t{j}") for j, t in enumerate(texts)])
    assert hits.where(sum(F.col(c) for c in hits.columns) != 1).count() == 0
    sizes = hits.agg(*[F.sum(c).alias(c) for c in hits.columns]).first()
    if shape not in ("nulls", "few", "dates"):
        assert max(sizes) <= 1.5 * len(rows) / 8 + 2
    # rows that came later are read as well
    late = spark.createDataFrame([(-5, 1), (10**9, 2)], "k long, i long") if shape != "dates" else None
    if late is not None:
        assert late.where(" OR ".join(texts)).count() == 2
