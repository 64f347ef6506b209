import random
import zlib

import numpy as np
import pytest

from quayside.llm import packing
from quayside.llm.queries import QUERIES, tokenizer_path
from tests.llm.corpus import SCHEMA, documents, frame
from tests.llm.test_token_files import ODD


def rows_of():
    return documents() + [(600 + i, t, "en", "s", 1, 0.5, 1, "w") for i, t in enumerate(ODD)]


def whole_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, 0] for e in tokenizer.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]


def cut(rows, capacity):
    out = []
    for r, ids in zip(rows, whole_ids(rows)):
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            out.append((str(r[0]), at // capacity, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    return sorted(out)


def least_sum(lengths, capacity):
    """The rule spelt out: every open sequence is tried, and the sum of squares counted anew."""
    fills = []
    for s in sorted(lengths, reverse=True):
        best = None
        for k, fill in enumerate(fills):
            if fill + s <= capacity and fill < capacity:
                after = [*fills[:k], fill + s, *fills[k + 1 :]]
                gaps = [capacity - f for f in after if f < capacity]
                total = sum(gaps.count(g) ** 2 for g in set(gaps))
                best = min(best or (1 << 60, 0, 0), (total, capacity - fill, k))
        if best is None:
            fills.append(s)
        else:
            fills[best[2]] += s
    return sorted(fills)


@pytest.mark.parametrize("capacity", [1, 7, 30])
def test_rule_against_trying_all(capacity):
    rng = random.Random(capacity)
    for _ in range(40):
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(0, 25))], dtype=np.int64)
        sequence, offset, filled = packing.placed(lengths, capacity)
        assert sorted(filled.tolist()) == least_sum(lengths.tolist(), capacity)
        for k, fill in enumerate(filled.tolist()):
            inside = sorted(zip(offset[sequence == k].tolist(), lengths[sequence == k].tolist()))
            assert [a for a, _ in inside] == np.cumsum([0, *[n for _, n in inside]])[:-1].tolist()
            assert sum(n for _, n in inside) == fill <= capacity


def best_fit(lengths, capacity):
    fills = []
    for s in sorted(lengths, reverse=True):
        fits = [k for k, f in enumerate(fills) if f + s <= capacity]
        if fits:
            fills[max(fits, key=lambda k: fills[k])] += s
        else:
            fills.append(s)
    return len(fills)


def sound(rows, capacity):
    """Every sequence is filled from 0 without gaps and not over capacity."""
    per = {}
    for r in rows:
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in per.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(per)


@pytest.mark.parametrize(("block", "capacity"), [(1 << 16, 2048), (4, 64), (1, 64)])
def test_pieces_and_sequences(spark, monkeypatch, block, capacity):
    monkeypatch.setattr(packing, "BLOCK", block)
    rows = rows_of()
    got = packing.packed(packing.token_pieces(frame(spark, rows), tokenizer_path(), capacity=capacity), capacity=capacity).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == cut(rows, capacity)
    used = sound(got, capacity)
    if block > 100:
        assert used <= best_fit([x[3] for x in cut(rows, capacity)], capacity) + 1


@pytest.mark.parametrize("block", [1 << 16, 150])
def test_leftovers_of_blocks_are_packed_again(spark, monkeypatch, block):
    """With many blocks not many more sequences are used than with one, nor than a plain best fit uses."""
    monkeypatch.setattr(packing, "BLOCK", block)
    rng = random.Random(4)
    lengths = [min(2048, int(rng.lognormvariate(6, 0.9)) + 1) for _ in range(3000)]
    df = spark.createDataFrame([(n, "x") for n in lengths], "length long, offset string").repartition(6)
    got = packing.packed(df).collect()
    assert sorted(r["length"] for r in got) == sorted(lengths)
    assert sound(got, 2048) <= 1.01 * best_fit(lengths, 2048) + 2
    assert (len({r["sequence_id"] >> packing.LEVEL_BITS for r in got}) > 1) == (block < 3000)


def test_lengths_that_never_share_end(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 10)
    got = packing.packed(spark.createDataFrame([(1100,)] * 60, "length long")).collect()
    assert sound(got, 2048) == 60


def test_sequences_hold_the_ids(spark):
    rows = rows_of()
    got = packing.packed_sequences(frame(spark, rows), tokenizer_path(), capacity=256).collect()
    parts = []
    for r in got:
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert len(ids) == r["length"] <= 256
        for doc, a, b in zip(r["doc_ids"], r["starts"], [*r["starts"][1:], len(ids)]):
            parts.append((str(doc), b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted(parts) == sorted((d, n, c) for d, _, _, n, c in cut(rows, 256))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.packed(packing.token_pieces(none, tokenizer_path())).collect() == []
    assert packing.packed_sequences(none, tokenizer_path()).collect() == []


def test_query_against_whole_texts(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_packing"](spark, sf).collect()
    want = cut(rows, 2048)
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert sound(got, 2048) <= best_fit([x[3] for x in want], 2048) + 1
