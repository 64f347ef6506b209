"""Walks upstream: few rounds on deep graphs, least distances on any."""

import random

import pytest

from quayside.operators import lineage


def walked(spark, edges, starts, monkeypatch):
    walks = []
    keep = lineage._Walk.keep

    def kept(self, nodes):
        walks.append(self)
        return keep(self, nodes)

    monkeypatch.setattr(lineage._Walk, "keep", kept)
    df = spark.createDataFrame(edges, "src long, trg long")
    out = lineage.upstream(df, spark.createDataFrame([(s,) for s in starts], "node long")).collect()
    assert len(out) == len({r["node"] for r in out})
    return {r["node"]: r["distance"] for r in out}, len(walks)


def breadth_first(edges, starts):
    into, found, layer, d = {}, {}, set(starts), 0
    for a, b in edges:
        into.setdefault(b, set()).add(a)
    while layer:
        found.update({n: d for n in layer})
        layer, d = {a for n in layer for a in into.get(n, ())} - set(found), d + 1
    return found


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    edges = [(i + 1, i) for i in range(10_000)]
    found, rounds = walked(spark, edges, [0], monkeypatch)
    assert found == {i: i for i in range(10_001)}
    assert rounds <= 20


@pytest.mark.parametrize("most", [8, 0])
@pytest.mark.parametrize("seed", range(3))
def test_distances_are_least(spark, monkeypatch, seed, most):
    monkeypatch.setattr(lineage, "MOST_WAYS", most)
    monkeypatch.setattr(lineage, "SINGLE_STEPS", 2)
    rng = random.Random(seed)
    n = 120
    edges = [(i + rng.choice([1, 1, 2, 7]), i) for i in range(n) for _ in range(rng.choice([1, 1, 2]))]
    edges += [(rng.randrange(n), rng.randrange(n)) for _ in range(4)] + [(5, 5), (None, 3), (500, 501)]
    starts = [0, 77]
    found, _ = walked(spark, edges, starts, monkeypatch)
    assert found == breadth_first([e for e in edges if e[0] is not None], starts)


def test_a_cycle_ends(spark, monkeypatch):
    edges = [((i + 1) % 40, i) for i in range(40)]
    found, rounds = walked(spark, edges, [3], monkeypatch)
    assert found == {(3 + d) % 40: d for d in range(40)} and rounds <= 14
