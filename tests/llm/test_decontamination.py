import hashlib
import random
import re

import pytest

from quayside.llm import decontamination
from tests.llm.corpus import SCHEMA, documents, frame, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(decontamination.UPPER, decontamination.LOWER)


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, size=10):
    held = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            held.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = []
    for r in rows:
        w, hit, found = words_of(r[1]), set(), set()
        for n in {len(k) for k in held}:
            for k in range(len(w) - n + 1):
                if whose := held.get(tuple(w[k : k + n])):
                    found |= whose
                    hit.update(range(k, k + n))
        out.append((str(r[0]), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def told(df):
    return sorted((str(r["_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect())


def planted():
    rng = random.Random(7)
    rows = documents()
    items = [(i, prose(rng, rng.randint(4, 40)).upper() if i % 2 else prose(rng, 25)) for i in range(12)]
    items += [(50, None), (51, ""), (52, "..."), (53, items[0][1]), (None, items[1][1]), (54, "Ünï ÇÖDÉ")]
    for i, (_, text) in enumerate(items[:8]):
        w = text.split()
        cut = w[: max(10, len(w) // 2)] if i % 2 else w
        rows.append((2000 + i, prose(rng, 11) + ", " + " -- ".join(cut).swapcase() + "; " + prose(rng, 5), "en", "s", 1, 0.1, 1, "w"))
    rows.append((3000, "ünï çödé x Ünï çÖdé", "en", "s", 1, 0.1, 1, "w"))
    return rows, items


@pytest.mark.parametrize("lists", [1, 2, 4])
def test_against_brute_force(spark, lists):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as _h", "'x' as start")
    assert told(decontamination.contamination_report(frame(spark, rows), bench, lists=lists)) == brute(rows, items)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_TERMS", -1)
    monkeypatch.setattr(decontamination, "BROADCAST_DOCUMENTS", -1)
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert told(decontamination.contamination_report(frame(spark, rows), bench)) == brute(rows, items)


def test_decontaminated_keeps_clean_rows_with_their_columns(spark):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.decontaminated(frame(spark, rows), bench)
    clean = [r for r, b in zip(rows, [x for r in rows for x in brute([r], items)]) if not b[-1]]
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame(clean, SCHEMA).collect()))


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, item), (2, item.replace("gamma", "gamma so").replace("delta", "other")), (3, "alpha kappa"), (4, item.replace("beta", "beta so")),
        (5, "alpha nothing of beta that was said here before gamma or rather delta"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    matches, _, _ = decontamination.benchmark_matches(docs, bench)
    assert {(r["_id"], r["exact"]) for r in matches.collect() if r["_id"] != 1} == {(2, False), (4, False)}
    assert {r["_id"]: (r["n_near"], r["contaminated"]) for r in decontamination.contamination_report(docs, bench).collect()} == {
        1: (0, True), 2: (1, False), 3: (0, False), 4: (1, False), 5: (0, False)}


@pytest.mark.parametrize("changed", range(10))
def test_a_passage_with_one_word_changed_is_near(spark, changed):
    """Also if it is the rarest: the others still meet."""
    item = [f"w{k}" for k in range(10)]
    rest = [(10 + k, " ".join(item[k + 1 :])) for k in range(9)]  # earlier words are rarer
    rows = [(1, " ".join(["new" if k == changed else w for k, w in enumerate(item)])), (2, " ".join(item)), *rest]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["_id"]: (r["n_near"], r["contaminated"]) for r in decontamination.contamination_report(docs, bench).collect()}
    assert got[1] == (1, False) and got[2] == (0, True)


def test_empty_tables(spark):
    docs, bench = frame(spark, documents()), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.contamination_report(docs.limit(0), bench).collect() == []
    assert {r["contaminated"] for r in decontamination.contamination_report(docs, bench.limit(0)).collect()} == {False}


def test_places_are_not_shuffled(spark, monkeypatch):
    """Postings are, once; of the places, several times as many, no row is, however many documents meet a phrase."""
    plans, write = {}, decontamination.saved

    def planned(df, label, *rest):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label, *rest)

    monkeypatch.setattr(decontamination, "saved", planned)
    monkeypatch.setattr(decontamination, "BROADCAST_DOCUMENTS", -1)
    monkeypatch.setattr(decontamination, "TASK_ROWS", 5, raising=False)
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id long, text string")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert told(decontamination.contamination_report(frame(spark, rows), bench)) == brute(rows, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert "SortMergeJoin" not in plans["phrase-starts"]
    moved = [line for line in plans["phrase-starts"].splitlines() if " Exchange " in line]
    assert len(moved) == 1 and "REPARTITION_BY_NUM" in moved[0] and int(re.search(r"(\d+)\), REPARTITION", moved[0])[1]) > 4
