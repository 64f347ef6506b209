import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import sharding
from tests.llm.corpus import SCHEMA, documents, frame


def least_capacity(sizes, shards):
    """By trying all cuts: best[k][i] is the least capacity for the first i sizes in k shards."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(len(sizes) + 1)]
    return best[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=14), st.integers(1, 6))
def test_cut_is_minimax(sizes, shards):
    array = np.array(sizes, dtype=np.int64)
    want = least_capacity(sizes, shards)
    assert sharding.min_capacity(array, shards) == want
    shard = sharding.cut(array, shards)
    assert (np.diff(shard) >= 0).all() and shard.min() >= 0 and shard.max() < shards
    assert np.bincount(shard, weights=array).max() == want


def test_giants_leave_the_rest_even():
    sizes = np.array([1] * 90 + [500], dtype=np.int64)
    shard = sharding.plan_shards(sizes, 10)
    assert np.bincount(shard, weights=sizes, minlength=10).tolist() == [500] + [10] * 9


def check(rows, got, shards):
    texts, slots = defaultdict(set), defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        texts[r["group_hash"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in texts.values()) and set(slots) <= set(range(shards))
    told = sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got)
    assert told == sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)


def test_groups_slots_and_sizes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STRETCH", 3)
    rows = documents()
    df = frame(spark, rows)
    got = sharding.assign_shards(df, 5).collect()
    check(rows, got, 5)
    assert sorted(map(str, got)) == sorted(map(str, sharding.assign_shards(df.repartition(5), 5).collect()))


def test_a_third_are_copies(spark):
    rows = [(i, "copy " * 9 if i % 3 == 0 else f"text {i} " * 9) for i in range(300)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check(rows, got, 8)
    sums = defaultdict(int)
    for r in got:
        sums[r["shard"]] += r["size"]
    rest = sorted(sums.values())[:-1]
    assert len(sums) == 8 and rest[-1] - rest[0] <= 2 * (16 + 9 * 9)


def test_cells_stand_for_small_groups(spark, monkeypatch):
    """With few cells and no group listed alone, groups still stay whole."""
    monkeypatch.setattr(sharding, "CELL_DIGITS", 2)
    monkeypatch.setattr(sharding, "ALONE", 1)
    rows = [(i, f"text {i % 500}") for i in range(1000)]
    check(rows, sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect(), 4)


def test_empty_table(spark):
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA), 4).collect() == []
