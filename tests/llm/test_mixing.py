import re
from collections import defaultdict

import pytest

from quayside.llm import mixing
from tests.llm.corpus import SCHEMA, documents, frame


def targets(sizes, weights=(5, 2, 1), limit=3.0):
    """By sharing again and again what is over the limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(limit * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        told = {s: limit * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and told[s] > limit * sizes[s]}
        if not over:
            return told
        capped |= over


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    want = targets(sizes)
    copies, expected = defaultdict(int), defaultdict(float)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 3
        ratio = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(ratio + 1e-9) <= r["copies"] <= int(ratio + 1 - 1e-9) + (ratio > 0)
        copies[r["source"]] += r["copies"]
        expected[r["source"]] += ratio
    assert all(abs(copies[s] - expected[s]) < 1 + 1e-6 for s in copies)
    assert sorted((str(r["id"]), r["size"]) for r in got) == sorted((str(r[0]), size_of(r[1])) for r in rows)


def test_targets_sums_and_limits(spark):
    rows = documents()
    check(rows, mixing.mix_plan(frame(spark, rows)).collect())


def test_many_blocks_and_levels(spark):
    rows = [(i, "w " * (1 + i * i % 97), "en", "ab"[i % 3 // 2], 0, 0.0, 0, "") for i in range(1500)]
    plan = mixing.mix_plan(frame(spark, rows), block=8).collect()
    check(rows, plan)
    for source in "ab":
        own = [r for r in plan if r["source"] == source]
        assert sum(r["copies"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=0.02)


def test_reruns_agree_and_seeds_differ(spark):
    rows = documents()
    one = mixing.mix_plan(frame(spark, rows)).collect()
    assert sorted(map(str, one)) == sorted(map(str, mixing.mix_plan(frame(spark, rows).repartition(7, "lang")).collect()))
    assert sorted(map(str, one)) != sorted(map(str, mixing.mix_plan(frame(spark, rows), seed=99).collect()))


def test_a_source_above_its_limit(spark):
    rows = [(0, "w " * 4, "", "a", 0, 0.0, 0, ""), (1, "w " * 100, "", "b", 0, 0.0, 0, ""), (2, " ", "", "c", 0, 0.0, 0, "")]
    got = mixing.mix_plan(frame(spark, rows)).collect()
    check(rows, got)
    assert {r["source"]: r["copies"] for r in got}["a"] == 3


def test_mixed_repeats_rows_with_their_columns(spark):
    rows = documents()
    df = frame(spark, rows)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    want = sorted((str(r["id"]), r["size"]) for r in mixing.mix_plan(df).collect() for _ in range(r["copies"]))
    assert sorted((str(r["doc_id"]), size_of(r["text"])) for r in out.collect()) == want


def test_empty_table(spark):
    assert mixing.mix_plan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
