import random

import numpy as np
import pytest
import xxhash

from quayside.llm import simhash
from quayside.llm.components import components
from tests.llm.corpus import SCHEMA, documents, frame


def fingerprint(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    pieces = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for p in pieces:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(pieces))


def groups(values, distance):
    label = list(range(len(values)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= distance:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(values))]


def test_against_brute_force(spark):
    rows = documents()
    prints = [fingerprint(r[1]) for r in rows]
    where = groups(prints, 2)
    least = {}
    for r, g in zip(rows, where):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    got = simhash.near_duplicates(frame(spark, rows)).select("_id", simhash.fingerprint_hex(simhash.F.col("fp")).alias("f"), "component_id").collect()
    want = sorted((str(r[0]), f"{p:016x}", str(least.get(g))) for r, p, g in zip(rows, prints, where))
    assert sorted((str(r["_id"]), r["f"], str(r["component_id"])) for r in got) == want


def gray_sorted(values):
    rank = values.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return values[np.argsort(rank)]


def cloud(seed, centres, each, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
def test_tree_finds_every_pair(distance):
    values = gray_sorted(cloud(1, 12, 60, 4))
    found = {(int(i), int(j)) for a, b in simhash.near_pairs(values, distance) for i, j in zip(a, b)}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j}


@pytest.mark.parametrize(("most", "distance"), [(4096, 2), (3, 2), (3, 0), (20, 3)])
def test_links_hold_together_all_within_the_distance(spark, monkeypatch, most, distance):
    """Also where nodes are cut again and again."""
    monkeypatch.setattr(simhash, "NODE_MOST", most)
    values = cloud(2, 6, 40, 3)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = {r["vertex"]: r["root"] for r in components(simhash.fingerprint_links(df, distance)).collect()}
    got = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    want = groups([int(v) for v in values], distance)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_masks_cover_all_flips():
    for distance in (0, 1, 2, 3):
        masks = simhash.first_masks(distance)
        rng = random.Random(distance)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), distance))
            hit = [m for m in masks if not m & (1 << 64) - 1 & flips]
            assert hit and any(not w & (1 << 64) - 1 & flips for w in simhash.wider_masks(hit[0], distance))


def test_components(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(1000, 1200)] + [(5, i) for i in range(6, 60)] + [(7, 7)]
    links += [(rng.randint(2000, 2080), rng.randint(2000, 2080)) for _ in range(50)]
    values = sorted({x for link in links for x in link})
    label = {v: v for v in values}
    for _ in values:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["vertex"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_deduplicated_keeps_the_first_of_each_group(spark):
    rows = documents()
    df = frame(spark, rows)
    groups_ = simhash.near_duplicates(df).collect()
    out = simhash.deduplicated(df)
    assert out.columns == df.columns
    kept = out.collect()
    assert len(kept) == len({r["root"] for r in groups_})
    # one per group: two groups can have the same smallest id, if rows share it
    want = sorted(str(i) for i in {r["root"]: r["component_id"] for r in groups_}.values())
    assert sorted(str(r["doc_id"]) for r in kept) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert simhash.deduplicated(spark.createDataFrame([], SCHEMA)).collect() == []
