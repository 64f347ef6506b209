import random
import zlib

import numpy as np

from quayside.llm import toxicity
from tests.llm.corpus import SCHEMA, documents, frame, prose


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def labelled(n=600, seed=3):
    """Only an insult next to a group is toxic; either alone is not."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = prose(rng, 30) + (" scumbags!" if insult else "") + (" those Foreigners, " if group else " ") + prose(rng, 20)
        rows.append((i, text, "en", "s", 1, 0.5, 1, "w"))
        labels.append((i, int(insult and group)))
    return rows, labels


def test_learns_what_terms_say_together(spark):
    rows, labels = labelled()
    got = toxicity.toxicity_report(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    known = dict(labels)
    assert {r["doc_id"]: r["held_out"] for r in got} == {r[0]: held(r[0]) for r in rows}
    out = [r for r in got if r["held_out"]]
    assert len(out) > 100 and np.mean([r["predicted"] == known[r["doc_id"]] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_held_out_labels_are_never_learnt(spark):
    rows, labels = labelled(200)
    turned = [(i, 1 - y if held(i) else y) for i, y in labels]
    models = [toxicity.train(frame(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned)]
    assert models[0].bias == models[1].bias and np.array_equal(models[0].weights, models[1].weights)


def test_heads_reach_words_never_seen(spark):
    rng = random.Random(2)
    ends = ["ung", "er", "ling", "haft", "chen", "lein", "tum", "ig"]
    rows = [(i, prose(rng, 30) + (f" lumpe{ends[i % 6]} " if i % 4 == 0 else " ") + prose(rng, 9), "", "", 1, 0.0, 0, "") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows += [(1000, "some lumpetum here", "", "", 1, 0.0, 0, ""), (1001, "nothing here", "", "", 1, 0.0, 0, "")]
    got = {r["doc_id"]: r for r in toxicity.toxicity_report(frame(spark, rows), labels).collect()}
    assert got[1000]["predicted"] == 1 and got[1001]["predicted"] == 0


def test_pairs_in_closed_form():
    """The sum over all pairs is what the closed form says."""
    rng = np.random.default_rng(1)
    m = toxicity.FactorizationMachine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 8)))
    for row in ([], [2], [0, 3, 5]):
        raw = 0.3 + sum(m.weights[i] for i in row) + sum(m.vectors[i] @ m.vectors[j] for i in row for j in row if i < j)
        assert np.isclose(m.scores([np.array(row, dtype=np.int64)])[0], 1 / (1 + np.exp(-raw)))


def test_machine_learns_a_pair_whose_terms_tell_nothing_alone():
    """Each term is as common in one class as in the other, so no additive weights tell them apart."""
    rows = [np.array(r, dtype=np.int64) for r in ([], [0], [1], [0, 1])] * 30
    labels = np.array([1.0, 0.0, 0.0, 1.0] * 30)
    model = toxicity.fit(np.arange(2), rows, labels)
    none, first, second, both = model.scores(rows[:4])
    assert min(none, both) > 0.7 > 0.3 > max(first, second)


def test_edges(spark):
    rows = documents()
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(9)] + [(None, 1, None), (3, None, None)], "doc_id long, toxic int, text string")
    got = toxicity.toxicity_report(df, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert {r["score"] for r in toxicity.toxicity_report(df, labels.limit(0)).collect()} <= {got_ for got_ in [toxicity.fit(np.zeros(0, int), [], np.zeros(0)).scores([np.zeros(0, int)])[0]]}
    assert toxicity.toxicity_report(spark.createDataFrame([], SCHEMA), labels).collect() == []
    model = toxicity.train(df, labels)
    kept = toxicity.not_toxic(df, model)
    assert kept.columns == df.columns and kept.count() <= len(rows)


def test_many_telling_terms_are_all_kept(spark):
    """700 words of toxic rows and their heads are 3,500 terms; each of them tells the classes apart."""
    rng = random.Random(4)
    words = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 8)) for _ in range(700)]
    rows = [(i, " ".join([*words, str(i)]) if i % 2 else prose(rng, 9), "", "", 1, 0.0, 0, "") for i in range(120)]
    model = toxicity.train(frame(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int"))
    want = set().union(*map(toxicity._buckets, words))
    assert len(want) > 3000 and want <= set(model.terms.tolist())
