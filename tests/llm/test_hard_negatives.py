import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score long, mark string, values string, size int"


def vectors(seed=1, n=400, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        v = centres[int(rng.integers(0, 4))] * 0.5 + rng.normal(size=dim) * 0.4
        rows.append([i, (v * rng.choice([0.2, 1.0, 1.0, 3.0])).tolist(), label])
    rows[20][1] = rows[21][1] = rows[30][1] = rows[41][1]  # equal vectors
    rows += [[50 * k, rows[3][1], 2] for k in (200, 300)]  # an anchor's copies
    rows += [list(rows[0]), list(rows[0]), [40, rows[7][1], 1]]  # a repeated row, an id with two vectors
    rows += [[1000 + i, [0.0] * dim, i % 4] for i in range(6)]  # no length
    rows += [[2000, None, 1], [2001, [None] + [0.5] * (dim - 1), 1], [2002, [math.nan] * dim, 2], [2003, [math.inf] * dim, 2]]
    rows += [[2004, rows[1][1], None], [None, rows[1][1], 1], [2100, [0.1, 0.2], 1], [2110, [0.3, 0.1], 2], [2120, [0.2, 0.2], 1], [2130, [], 0]]
    rows += [[3000 + i, rows[5][1], 3] for i in range(40)]  # one common vector
    return [(i, v, l, "x", 1, "m", "v", 0) for i, v, l in rows]


def expected(rows, every, positives=5, negatives=3, low=50, high=95):
    kept = set()
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.add((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    kept = sorted(kept)
    out = []
    for a in kept:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r) for r in kept if r != a and len(r[2]) == len(a[2]))
        for s, pid, _ in [x for x in scored if x[2][1] == a[1]][:positives]:
            fits = [(-n, nid) for n, nid, r in scored if r[1] != a[1] and low * -s <= 100 * -n <= high * -s]
            out += [(a[0], pid, k + 1, nid, -s, n) for k, (n, nid) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("block", "run", "anchors", "focus"), [(4096, 512, 2048, 6), (50, 8, 7, 3), (16, 4, 2048, 1)])
def test_against_all_pairs(spark, monkeypatch, block, run, anchors, focus):
    for name, value in (("BLOCK", block), ("RUN", run), ("ANCHORS", anchors), ("FOCUS", focus)):
        monkeypatch.setattr(hn, name, value)
    rows = vectors()
    got = hn.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = expected(rows, 10)
    assert len(want) > 300
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize("seed", range(4))
def test_candidates_miss_nothing_and_leave_much_out(monkeypatch, seed):
    monkeypatch.setattr(hn, "RUN", 64)
    rng = np.random.default_rng(seed)
    values = np.floor(rng.normal(size=(600, 16)) * 90 * rng.choice([0.3, 1, 2], size=(600, 1))).astype(np.int64)
    lists, seen = hn.Lists(values), 0
    for q in values[:40]:
        score = values @ q
        for wanted in (np.sort(score)[-4], np.sort(score)[-40], 0, -5):
            found = [c for c in lists.candidates(q, lambda: wanted)]
            places = lists.order[np.concatenate(found)] if found else np.zeros(0, dtype=int)
            assert set(np.flatnonzero(score >= wanted).tolist()) <= set(places.tolist())
            seen += len(places) if wanted == np.sort(score)[-4] else 0
            assert (lists.scores(np.arange(600), q) == score[lists.order]).all()
    assert seen < 0.5 * 40 * 600


def test_large_values_are_scored_exactly():
    values = np.array([[1 << 30, 3], [1 << 30, 2], [1, 1]], dtype=np.int64)
    lists = hn.Lists(values)
    assert lists.scores(np.arange(3), values[0]).tolist() == (values[lists.order] @ values[0]).tolist()


def test_range_of_scores_holds_at_its_ends(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.95, 0.0], 1), (3, [0.5, 0.0], 1), (4, [0.96, 0.0], 1), (5, [0.49, 0.0], 1), (6, [0.5, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hn.hard_negatives(df, F.col("id") == 0, scale=100).select("positive_id", "rank", "negative_id", "negative_score").collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 2, 9500), (1, 2, 3, 5000), (1, 3, 6, 5000)]


def test_empty_and_single(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hn.hard_negatives(spark.createDataFrame([], schema), F.col("id") % 10 == 0).collect() == []
    assert hn.hard_negatives(spark.createDataFrame([(0, [1.0], 1)], schema), F.col("id") % 10 == 0).collect() == []
