"""Bytes of later repeats against brute force over all strings."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from quayside.llm import suffix_dedup
from tests.llm.corpus import SCHEMA, documents, frame


def brute(rows, length):
    """Removed bytes of each distinct (id, text), in the order of id (null first) and text hash."""
    def mark(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    keys = sorted({(r[0] is not None, r[0] or 0, mark(r[1] or ""), r[1] or "") for r in rows})
    seen, out = set(), {}
    for has_id, i, _, text in keys:
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        out[(i if has_id else None, text)] = (len(data), int(gone.sum()), int((np.diff(np.r_[0, gone]) == 1).sum()), np.frombuffer(data, np.uint8)[~gone].tobytes())
    return sorted((str(r[0]), *out[(r[0], r[1] or "")]) for r in rows)


def passages():
    """One line in ever new surroundings, by ids of their own."""
    rng = random.Random(8)
    line = " ".join(f"{rng.getrandbits(20):x}" for _ in range(30))
    other = " ".join(f"{rng.getrandbits(20):x}" for _ in range(30))
    rows = []
    for i in range(60):
        before, behind = (" ".join(f"{rng.getrandbits(20):x}" for _ in range(rng.randint(0, 12))) for _ in range(2))
        cut = rng.randint(0, 40)
        rows.append((i, f"{before} {line[cut:]} {behind}" + other * (i % 5 == 0), "en", "s", 1, 0.5, 1, "w"))
    return [*rows, *((100 + i, rows[i][1], *rows[i][2:]) for i in range(8))]


@pytest.mark.parametrize("rows", [documents(), passages()], ids=["documents", "passages"])
@pytest.mark.parametrize(("length", "gram", "hot", "hot_rows"), [(100, 32, 4096, 1 << 16), (30, 8, 4096, 1 << 16), (30, 8, 2, 1 << 16), (30, 8, 4096, 3), (30, 16, 4096, 1 << 16)])
def test_against_brute_force(spark, monkeypatch, rows, length, gram, hot, hot_rows):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot_rows)
    got = suffix_dedup.remove_repeats(frame(spark, rows), length=length, gram=gram).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == brute(rows, length)


def test_small_portions(spark, monkeypatch):
    """Segments cut at the edges of portions are still found."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    monkeypatch.setattr(suffix_dedup, "HELD", 50)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    monkeypatch.setattr(suffix_dedup, "SUFFIXES", 40)
    monkeypatch.setattr(suffix_dedup, "_POWERS", {})
    rows = documents(2, 12)
    got = suffix_dedup.remove_repeats(frame(spark, rows), length=40, gram=8).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == brute(rows, 40)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_previous_factors_against_all_pairs():
    rng = random.Random(4)
    for _ in range(100):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 40)))
        order = sorted(range(len(text)), key=lambda i: text[i:])

        def common(a, b, text=text):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            return n

        shared = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
        want = [max([common(i, j) for j in range(i)], default=0) for i in range(len(text))]
        assert suffix_dedup.previous_factors(np.array(order), shared, 1).tolist() == want


def test_kept_text_of_a_copy_is_empty(spark):
    text = "".join(hashlib.sha256(bytes([k])).hexdigest() for k in range(5))
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark.createDataFrame([(2, text), (1, text)], "doc_id long, text string")).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"], bytes(got[2]["kept"]), got[2]["spans"][0]) == (0, 320, b"", (0, 320))
