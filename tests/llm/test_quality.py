import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from quayside.llm import quality
from tests.llm.corpus import SCHEMA, documents, frame

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows_of():
    rows = documents()
    line = "one two three four five six seven eight nine ten"
    texts = ["\n".join([line, line, "  ", line + " x"]) * 3, "### %% a|b <c> $ & " * 9, "w " * 19, "w%d " * 3, " ".join(f"w{i}" for i in range(20))]
    return rows + [(500 + i, t, "en", "s", 1, 0.5, 1, "w") for i, t in enumerate(texts)]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(quality.SYMBOL, text)), len(lines) - len(set(lines)), len(covered), failed


def buckets(text):
    w = WORD.findall(text or "")
    one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
    two = [xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42)) for a, b in zip(one, one[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % quality.BUCKETS for h in one + two]


def test_base_counts(spark):
    rows = rows_of()
    got = quality.quality_report(frame(spark, rows), spark.createDataFrame([(0,)], "doc_id long")).collect()
    told = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    assert told == sorted((str(r[0]), *base(r[1])) for r in rows)
    assert all(r["kept"] == (not r["base_failed"] and r["llr"] >= quality.THRESHOLD) for r in got)


def test_ratio_is_the_mean_over_all_grams(spark):
    rows, trusted = rows_of(), {1, 2, 3, 8}
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(buckets(r[1]))
        if r[0] in trusted:
            target.update(buckets(r[1]))
    n_raw, n_target = raw.total() + quality.BUCKETS, target.total() + quality.BUCKETS

    def llr(text):
        each = [math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in buckets(text)]
        return sum(each) / len(each) if each else 0.0

    ids = spark.createDataFrame([(i,) for i in [*trusted, 1, None, 99999]], "doc_id long")
    got = quality.quality_report(frame(spark, rows), ids).collect()
    told = sorted((str(r["doc_id"]), r["n_words"], round(r["llr"], 9)) for r in got)
    assert told == sorted((str(r[0]), len(WORD.findall(r[1] or "")), round(llr(r[1]), 9)) for r in rows)


def test_junk_is_less_like_the_target(spark):
    good = [(i, " ".join(f"word{(i * k) % 50}" for k in range(1, 60))) for i in range(40)]
    junk = [(100 + i, " ".join(f"zz{(i * k) % 37}$$" for k in range(1, 60))) for i in range(10)]
    ids = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    got = {r["doc_id"]: r for r in quality.quality_report(spark.createDataFrame(good + junk, "doc_id long, text string"), ids, threshold=0.0).collect()}
    worst = max(got[i]["llr"] for i, _ in junk)
    assert worst < 0 and worst < sum(got[i]["llr"] for i, _ in good) / len(good)


@pytest.mark.parametrize("trusted", [[], [(None,)]])
def test_empty_tables(spark, trusted):
    ids = spark.createDataFrame(trusted, "doc_id long")
    assert quality.quality_report(spark.createDataFrame([], SCHEMA), ids).collect() == []
    got = quality.quality_report(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), ids).collect()
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in got] == [(2, True, False)]


@pytest.mark.parametrize("most", [quality.BROADCAST_IDS, 10])
def test_target_is_counted_over_all_trusted_ids(spark, monkeypatch, most):
    monkeypatch.setattr(quality, "BROADCAST_IDS", most)
    docs = spark.range(60_000).selectExpr("id AS doc_id", "'a b' AS text")
    ids = spark.range(1000, 60_000).toDF("doc_id")
    sums = quality.bucket_counts(docs, ids, id_col="doc_id", text_col="text").selectExpr("sum(raw)", "sum(target)").first()
    assert [x - quality.BUCKETS for x in sums] == [3 * 60_000, 3 * 59_000]
