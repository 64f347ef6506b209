"""Statements, targets and reads of scripts, and reports over metadata."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quayside.operators import load, metrics, scripts
from tests.test_plans import plan

SCRIPT = """USE SCHEMA s1; -- it's a comment; with 'quotes
SET day = '2024-01-01';
INSERT INTO q.r VALUES ('a;b -- c', "x;y", 'it''s /* no */');/* a ; block
 -- of */ MERGE INTO mart.m t USING stg.x s ON t.a = s.a WHEN MATCHED THEN UPDATE SET t.b = s.b;
insert into "mart"."f#1" (a, b) select * from a.b x, c.d AS y left join "e"."f" z on z.k = x.k where k in (select k from g.h);
create temporary table ${db}.t as select 'from not.here' from i.j;
DELETE FROM k.l USING m.n WHERE 1 = 1; DROP VIEW o.p; DROP TABLE IF EXISTS o.q; SELECT 1 FROM r.s"""


def test_scripts_are_read_in_pieces(spark):
    df = scripts.statements(spark.createDataFrame([("p", SCRIPT), ("q", ""), ("r", None), ("s", "a 'open; end")], "path string, text string"))
    edges = scripts.dependency_edges(df).groupBy("path", "n", "write_type", "write_table").agg(F.sort_array(F.collect_list("read_table")).alias("reads"))
    got = [tuple(r) for r in edges.orderBy("n").collect()]
    assert got == [
        ("p", 3, "INSERT", "q.r", []), ("p", 4, "MERGE", "mart.m", ["stg.x"]),
        ("p", 5, "INSERT", '"mart"."f#1"', ['"e"."f"', "a.b", "c.d", "g.h"]), ("p", 6, "CREATE", "${db}.t", ["i.j"]),
        ("p", 7, "DELETE", "k.l", ["m.n"]), ("p", 8, "DROP", None, []), ("p", 9, "DROP", "o.q", []),
    ]
    text = {r["n"]: r["statement"] for r in df.where("path = 'p'").collect()}
    assert text[3].startswith("INSERT") and "'a;b -- c', \"x;y\", 'it''s /* no */'" in text[3] and text[4].startswith("MERGE")
    assert [r["statement"] for r in df.where("path = 's'").collect()] == ["a 'open; end"]


def test_session_settings(spark):
    got = scripts.session_params(spark.createDataFrame([("p", SCRIPT)], "path string, text string")).collect()
    assert {tuple(r) for r in got} == {("p", "set", "day", "2024-01-01"), ("p", "use", None, "USE SCHEMA s1")}


REWRITTEN = [
    ("x (CASESPECIFIC)", "x"), ("CURRENT_TIMESTAMP(6)", "CURRENT_TIMESTAMP()"), ("( CASE WHEN a THEN b END )", "CASE WHEN a THEN b END"),
    ("( CASE WHEN a END (DATE , FORMAT 'x'))", "CASE WHEN a END,'x'"), ("to_date(( CASE WHEN a END , 'x'", "to_date(CASE WHEN a END, 'x'"),
    (":ts (TIMESTAMP(6))", "nvl2(to_timestamp(:ts,yyyy-MM-dd HH:mm:ss.SSS'Z'),NULL)"),
    (":a = ' '", r"trim(regexp_replace(:a,'[\\s\\n]+','')) = ''"), (":a <> ' '", r"trim(regexp_replace(:a,'[\\s\\n]+','')) <> ''"),
]


def test_every_rewrite(spark):
    df = spark.createDataFrame([(a,) for a, _ in REWRITTEN], "e string")
    assert [r[0] for r in df.select(scripts.rewrite("e")).collect()] == [b for _, b in REWRITTEN]
    assert all(any(re.search(p, a) for a, _ in REWRITTEN) for p, _ in scripts.REWRITES)


MATCHED = [
    ("upper(:a)", "upper"), ("NULLIF(:a ,'~')", "nullif_text"), ("NULLIF(:a ,'x1') TO_TIMESTAMP('yyyy')", "nullif_to_timestamp"),
    ("NULLIF(:a ,'x1') TO_DATE('yyyy')", "nullif_to_date"), ("CASE WHEN :a = 'x' THEN NULL ELSE :a END (DATE, FORMAT 'y')", "nullif_to_date"),
    ("CASE WHEN :a = '' THEN NULL ELSE :a END", "empty_to_null_date"), ("DIVIDE(:a, 100 )", "divide"),
    ("CASE WHEN :a IS NULL THEN CURRENT_TIMESTAMP ELSE :a END", "now_if_empty"), ("COALESCE(NULLIF(:a, 'zz'),0)", "coalesce_nullif"),
    ("CASE WHEN :a 'q' THEN 'il' ELSE '??' END", "case_when_map"), ("CASE WHEN :a 'q' THEN '12' ELSE '0' END", "case_when_map"),
    ("CUSTOM_SUBSTRING_CHARLENGTH(:a)", "right_after_rtrim"), ("STRINGTODATEFORMATHIVEUDF(19,'yy')", "prefixed_date"),
    (":a||'-'||:b", "concat_columns"), ("nothing", None),
]


def test_function_rules(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(MATCHED)], "i int, e string")
    got = df.select("i", scripts.match_function("e")["function"].alias("f")).orderBy("i").collect()
    assert [r["f"] for r in got] == [b for _, b in MATCHED]


def test_json_values_of_any_shape(spark):
    held = [
        {"secret_id": "a"}, {"x": {"secret_id": 17}, "y": [{"secret_id": ["s1", "s2", 3]}]}, {"secret_id": 'q"x\\y'},
        {"secret_id": None, "n": '"secret_id": 5'}, {}, None, {"secret_id": {"a": 1}},
    ]
    df = spark.createDataFrame([(i, None if t is None else json.dumps(t)) for i, t in enumerate(held)], "i int, j string")
    got = [r[0] for r in df.orderBy("i").select(metrics.json_values("j", "secret_id")).collect()]
    assert got == [["a"], ["17", "s1", "s2", "3"], ['q"x\\y'], [], [], None, []]


def test_json_values_in_lists_with_brackets(spark):
    held = [
        {"secret_id": ["a", "x{1}", "y]"], "b": "c"}, {"secret_id": ["a", ["b", [4]], "c"], "n": ["d"]},
        {"secret_id": ["a", {"n": "b", "m": ["c"], "secret_id": ["d"]}, "e", None, True]}, {"secret_id": None, "l": ["a"]},
    ]
    df = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(held)], "i int, j string")
    got = [r[0] for r in df.orderBy("i").select(metrics.json_values("j", "secret_id")).collect()]
    assert got == [["a", "x{1}", "y]"], ["a", "b", "4", "c"], ["a", "d", "e"], []]


def test_rows_of_neither_kind_give_their_first(spark):
    shape = "job_id int, table_id int, job_type string, seq int, job_status string, fetch_records_count long, target_records_count long, " + ", ".join(
        f"{c} string" for c in ("source_schema_name", "source_database_name", "first_merged_watermark", "last_merged_watermark", "workflow_id", "workflow_run_id"))
    rows = [(1, 1, "OTHER", k, "DONE", 5 + k, 10, "s", "d", None, None, "w", "r") for k in (2, 1)]
    got = metrics.job_metrics_fact(spark.createDataFrame(rows, shape), ["seq"]).collect()
    assert [(r["job_type"], r["fetch_records_count"], r["pre_target_count"], r["workflow_id"]) for r in got] == [("OTHER", 6, 4, "w")]


def test_upsert_reads_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
        delta = spark.createDataFrame([("x", 2), ("y", 3), ("z", None)], "v string, k int")
        merged = load.merge_scd1(target, delta, ["k"])
        assert merged.columns == ["k", "v"] and plan(merged).count("Exchange hashpartitioning") == 2
        assert sorted(map(str, (tuple(r) for r in merged.collect()))) == sorted(map(str, [(1, "a"), (2, "x"), (3, "y"), (None, "c"), (None, "z")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["mod", "hashamp_hashbucket_hashrow", "yyyyMM"])
def test_split_texts_by_database(how):
    from quayside.sources.jdbc import Split, split_predicates

    texts = split_predicates(Split("c", how, 4), [202401, 202402] if how == "yyyyMM" else None, "sqlserver")
    assert not any("EXTRACT" in t for t in texts) and (how != "mod" or "(c % 4)" in texts[0])
    if how.startswith("hash"):
        assert all("MOD(HASHAMP(HASHBUCKET(HASHROW(c))), 4)" in t for t in texts)


STATEMENT_READS = [
    ("select * from a.b x, c.d AS y left join \"e\".\"f\" z on z.k = x.k where k in (select k from g.h, i.j), q.r", ['a.b', 'c.d', '"e"."f"', 'g.h', 'i.j']),
    ("SELECT a.x, b.y FROM t1, s.t2 WHERE 'from x.y' = 'it''s from z.w' ORDER BY a.b, c.d", ["s.t2"]),
    ("DELETE   FROM a.b USING c.d, e.f", ["c.d", "e.f"]), ("delete\nfrom a.b where x in (select y from c.d)", ["c.d"]),
    ("select x.from, y.join from.a, b.c from d.e", ["d.e"]), ("SELECT 1 FROM (a.b), c.d", []), ("select * from ${db}.t, $x.y, #t.z, lateral v.w", ["${db}.t", "$x.y", "#t.z"]),
    ('select * from "a b"."c,d", "x from y.z" join e.f', ['"a b"."c,d"', '"x from y.z"', "e.f"]), ('select * from a.b "al,q.r" , c.d', ["a.b", "c.d"]),
    ("MERGE INTO a.b USING c.d ON 1 = 1 WHEN MATCHED THEN UPDATE SET x = y.z, q = w.v", ["c.d"]), ("from a.b, a.b join a.b", ["a.b"]), ("", []), ("from", []),
    ("select * from a.b join c.d using (k) join e.f using (k)", ["a.b", "c.d", "e.f"]), ("select * from [a.b], {c.d}", ["a.b", "c.d"]),
    ("select * from it.s 'quoted' , u.v", ["it.s", "u.v"]), ("select * from \"unclosed a.b, c.d", ['"unclosed a.b, c.d']),
]


def test_reads_by_patterns_and_word_by_word(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(STATEMENT_READS)], "i int, statement string")
    rows = df.select("i", scripts.read_tables().alias("reads"), F.array_distinct(scripts._fold_reads(scripts._words("statement"))).alias("fold")).orderBy("i").collect()
    for r, (text, want) in zip(rows, STATEMENT_READS):
        assert r["reads"] == want == r["fold"], text


def test_long_lists_are_read(spark):
    names = [f"s{i}.t{i}" for i in range(6000)]
    text = "select * from " + " x, ".join(names) + " where a = 'b'"
    assert spark.createDataFrame([(text,)], "statement string").select(scripts.read_tables()).first()[0] == names


def test_rules_of_a_table_as_of_the_list(spark):
    rows = [(i, p, f, s) for i, (p, f, s) in enumerate(scripts.FUNCTION_RULES)]
    table = scripts.rule_table(spark.createDataFrame(rows, "place int, pattern string, function string, search string"))
    filed = {r["function"]: r["gram"] for r in table.collect()}
    assert filed["upper"] == "UPP" and filed["divide"] == "DIV" and filed["concat_columns"] == "" and filed["case_when_map"] == "WHE"
    texts = [a for a, _ in MATCHED] + [a for a, _ in REWRITTEN] + [
        None, "", "CASE WHEN :a 'x' THEN 'il' WHEN :b 'y' THEN 'el' ELSE '??' END", "case when :a 'q' then '12' when :b 'r' then '13' else '0' end"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, e string")
    one = df.select("i", scripts.match_function("e").alias("h")).select("i", "h.function", "h.params").orderBy("i").collect()
    two = scripts.match_rules(df, ["i"], "e", table).orderBy("i").collect()
    assert [tuple(r) for r in two] == [tuple(r) for r in one]


def test_required_literals():
    cases = {"UPPER": "UPPER", r"NULLIF\s*\(": "NULLIF", r"(?:\s*WHEN\s*x)(?:\s*ELSE)?": "WHEN", r"AB|CD": "", r"(?:ABC|D)E": "", r"(ABC)?D": "", r"ABCD*E": "ABC", "abc": "", r"\s*ABC(x|y)": "ABC"}
    assert {p: scripts.required_literal(p) for p in cases} == cases


def test_rules_meet_expressions_by_their_whole_literals(spark):
    """Rules that begin like a word of every expression, but are found in few, meet only those few."""
    names = ["DIVIDE" + "".join("ABCDEFGHIJ"[int(c)] for c in str(i)) for i in range(3000)]
    table = scripts.rule_table(spark.createDataFrame([(i, n + r"\s*\((\d+)", n.lower(), "single") for i, n in enumerate(names)], "place int, pattern string, function string, search string"))
    texts = [f"divide(x) {names[i] if i % 100 == 0 else ''} ({i})" for i in range(1000)] + ["divide(x)", "divide(x)"]
    df = spark.createDataFrame([(min(i, 1000), t) for i, t in enumerate(texts)], "i int, e string")
    hit = scripts.match_rules(df, ["i"], "e", table)
    rows = hit.collect()
    assert len(rows) == len(texts)  # an expression that comes twice stays twice
    assert sorted((r["i"], r["function"], *r["params"]) for r in rows if r["function"]) == [(i, names[i].lower(), str(i)) for i in range(0, 1000, 100)]
    assert "BuildLeft" not in plan(hit)  # expressions are never sent to all tasks


def test_many_possible_rules_meet_in_a_shuffle(spark, monkeypatch):
    rows = [(i, p, f, s) for i, (p, f, s) in enumerate(scripts.FUNCTION_RULES)]
    table = scripts.rule_table(spark.createDataFrame(rows, "place int, pattern string, function string, search string"))
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(MATCHED)], "i int, e string")
    want = sorted(map(str, scripts.match_rules(df, ["i"], "e", table).collect()))
    monkeypatch.setattr(scripts, "SENT_RULES", 1)
    assert sorted(map(str, scripts.match_rules(df, ["i"], "e", table).collect())) == want


def test_rule_query_sends_no_expressions(spark):
    from quayside.plans import QUERIES
    from tests.oracle import TESTDATA

    assert "BuildLeft" not in plan(QUERIES["j10_rule_table"](spark, f"{TESTDATA}/sf0.001"))
