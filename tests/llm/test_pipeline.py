"""Each stage on a small fixture, against what the operators' brute-force tests establish."""

import pathlib
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quayside.llm.queries import QUERIES
from tests.llm.corpus import prose
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash import fingerprint, groups

ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of tables with planted toxic texts, copies and benchmark passages."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        toxic = i % 5 == 0
        text = prose(rng, 40) + (" you scumbag idiot " if toxic else " ") + prose(rng, 20)
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    passage = prose(rng, 20)
    rows += [(300, rows[1][1], "en", "src0", 1), (301, rows[2][1].replace(" ", "  "), "en", "src1", 1)]
    rows += [(302, prose(rng, 12) + " " + passage, "en", "src2", 1), (303, "a new text by an idiot scumbag " + prose(rng, 30), "en", "src1", 1)]
    rows += [(None, None, None, None, None), (304, "", "en", "src1", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, passage


def test_stages(spark, folder):
    path, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        kept.append(out.collect())
        docs = spark.createDataFrame(kept[-1], out.schema)
    clean, single, unleaked, mixed, tokens = kept
    toxic = {i for i in range(240) if i % 5 == 0} | {303}
    assert {r["doc_id"] for r in clean} == ({r for r in range(240)} | {300, 301, 302, 304, None}) - toxic

    where = groups([fingerprint(r["text"]) for r in clean], 2)
    firsts = {}
    for r, g in zip(clean, where):
        firsts[g] = min(firsts.get(g, (True, 0)), (r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in single) == sorted(firsts.values())
    assert not {300, 301} & {r["doc_id"] for r in single}

    leaks = {r["doc_id"] for r in single if brute([tuple(r)], [(1, passage)])[0][-1]}
    assert leaks == {302} and {r["doc_id"] for r in unleaked} == {r["doc_id"] for r in single} - leaks
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in unleaked} and mixed[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r["doc_id"]) for r in tokens) == sorted(str(r["doc_id"]) for r in mixed)
    assert sum(r["n_tokens"] for r in tokens) == max(r["start"] + r["n_tokens"] for r in tokens)


def test_run_is_the_stages_one_after_another(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def test_entry_registers_the_operators(spark):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(QUERIES) <= set(entry.queries()) and entry.queries()["pipeline"] is corpus_pipeline.run


def test_sources_hold_no_forbidden_calls():
    for path in [*(ROOT / "quayside" / "llm").rglob("*.py"), ROOT / "corpus_pipeline.py"]:
        text = path.read_text()
        for call in ("localCheckpoint", "toPandas", "crossJoin", ".rdd", "tempfile", "except ImportError"):
            assert call not in text, f"{path}: {call}"


@pytest.mark.parametrize("name", ["op3_secrets", "op4_decontamination", "op5_quality", "op6_mixing", "op10_url_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
