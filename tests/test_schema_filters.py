import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import filters, schema
from quayside.operators.schema import ColumnSpec


def test_rejects_name_the_columns_that_did_not_parse(spark):
    raw = spark.sql("SELECT * FROM VALUES ('1', '20220219', '1.5'), ('x', '20220230', ''), (NULL, ' ', '1e99') AS v(a, b, c)")
    specs = [ColumnSpec("a", "int"), ColumnSpec("day", "date", "b", mask="yyyymmdd"), ColumnSpec("c", "decimal(4,2)")]
    out = schema.typed_projection(raw, specs, "rejects").collect()
    assert tuple(out[0]) == (1, dt.date(2022, 2, 19), decimal.Decimal("1.50"), [])
    assert out[1].rejects == ["a", "day"] and out[1].day is None
    assert out[2].rejects == ["c"]


def test_one_source_feeds_several_targets(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert schema.rename_map(df, {"a": ["x", "y"], "b": "z"}).first().asDict() == {"x": 1, "y": 1, "z": 2}


def test_float_widening_keeps_the_text(spark):
    df = spark.sql("SELECT cast(1.1 AS FLOAT) AS f, 1.1D AS d, 'x' AS s")
    assert tuple(schema.widen_floats(df).first()) == (1.1, 1.1, "x")


def test_missing_columns(spark):
    target = T.StructType().add("id", "integer").add("d", "date").add("amt", "decimal(9,2)").add("both", "string").add("DW_LOAD_TM", "string")
    out = schema.add_missing_columns(spark.sql("SELECT 1 AS id, 'u' AS u"), target, {"both": "(:u||'-'||:id)"})
    row = out.first()
    assert row.both == "u-1" and row.amt == decimal.Decimal("123.45") and row.d is not None and ":" in row.DW_LOAD_TM
    bare = schema.add_missing_columns(spark.sql("SELECT 1 AS id"), T.StructType().add("n", "integer"), use_defaults=False)
    assert bare.first().n is None


def test_null_defaults_by_type(spark):
    df = spark.sql("SELECT cast(NULL AS INT) i, cast(NULL AS STRING) s, cast(NULL AS DATE) d, cast(NULL AS BOOLEAN) b, cast(NULL AS FLOAT) f")
    row = schema.fill_null_defaults(df).first()
    assert (row.i, row.s, row.d, row.b) == (123, "", dt.date(1990, 1, 1), None)
    fallback = schema.fill_null_defaults(df, schema.FALLBACK_DEFAULTS).first()
    assert (fallback.i, fallback.d) == (0, dt.date(9999, 1, 1))


def test_names():
    assert schema.column_sizes("C_NAME:30, c_phone:50,bad,x:y") == {"C_NAME": 30, "C_PHONE": 50}
    assert schema.underscored("my big table") == "my_big_table"


def test_resolve_is_case_insensitive_and_strict(spark):
    df = spark.sql("SELECT 1 AS Id, 2 AS Name")
    assert schema.resolve(df, ["ID", "name"]) == ["Id", "Name"]
    with pytest.raises(ValueError, match="unknown columns"):
        schema.resolve(df, ["nope"])


def test_uppercase_only_exact_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    assert schema.uppercase_columns(df).columns == ["A", "B"]
    assert schema.uppercase_columns(df, ["a", "B"]).columns == ["A", "b"]


def test_nested_path(spark):
    df = spark.sql("""SELECT '{"a":{"b":[{"c":5}]}}' AS j""")
    out = df.select(schema.nested_path("j", "a.b.0.c"), schema.nested_path("j", "a.x"), schema.nested_path("j", "a.b.3.c")).first()
    assert tuple(out) == ("5", "", "")


ROWS = "SELECT * FROM VALUES (1, 'A', 10, 'x in y'), (2, 'B', NULL, 'it''s'), (3, NULL, 30, 'a,b'), (4, 'a', 40, '') AS v(l_linenumber, flag, qty, note)"


@pytest.mark.parametrize("rule,expected", [
    ("l_linenumber in (1, 3)", [1, 3]),
    ("L_LINENUMBER IN 1,3", [1, 3]),
    ("l_linenumber not in (1)", [2, 3, 4]),
    ("flag = A", [1]),
    ("flag='A' [or] flag is null", [1, 3]),
    ("flag <=> null", [3]),
    ("qty <> 10 [and] qty >= 40", [4]),
    ("qty <= 10 [OR] qty > 30", [1, 4]),
    ("note like '% in %'", [1]),
    ("note NOT LIKE '%,%'", [1, 2, 4]),
    ("note rlike ^it", [2]),
    ("note in ('a,b', 'it''s')", [2, 3]),
    ("note = it's", [2]),
    ("qty is not null [and] l_linenumber < 4", [1, 3]),
    ("l_linenumber = 1 [or] flag = B [and] qty = 99", [1]),
    ("", [1, 2, 3, 4]),
])
def test_subset_filter(spark, rule, expected):
    out = filters.subset_filter(spark.sql(ROWS), rule).orderBy("l_linenumber").collect()
    assert [r.l_linenumber for r in out] == expected


@pytest.mark.parametrize("rule", ["nope = 1", "qty ~ 3", "qty =", "qty is null x"])
def test_subset_filter_refuses(spark, rule):
    with pytest.raises(ValueError):
        filters.subset_filter(spark.sql(ROWS), rule)


def test_delete_where_keeps_unknown(spark):
    assert [r.l_linenumber for r in filters.delete_where(spark.sql(ROWS), "qty > 20").collect()] == [1, 2]


def test_high_water_with_several_marks(spark):
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-01', DATE'2021-01-01'), (2, DATE'2022-01-01', NULL), (3, NULL, NULL) AS v(i, a, b)")
    newer = filters.high_water_filter(df, ["a", "b"], dt.date(2020, 6, 1))
    assert [r.i for r in newer.orderBy("i").collect()] == [1, 2]
    assert filters.next_high_water(df, ["a", "b"]).first()[0] == dt.date(2022, 1, 1)


def test_exclude_listed_shares_quota(spark):
    configs = spark.createDataFrame([("t1", "g"), ("t2", "g"), ("t3", "g"), ("u1", "h")], "name string, grp string")
    listed = spark.createDataFrame([("t3",)], "name string")
    out = {r.name: r.quota for r in schema.exclude_listed(configs, listed, "name", "grp").collect()}
    assert out == {"t1": 50, "t2": 50, "u1": 100}


def test_epoch(spark):
    out = spark.sql("SELECT 86461L AS s").select(schema.epoch_to("s", "time"), schema.epoch_to("s", "date"), schema.epoch_to("s", "timestamp"))
    assert tuple(out.first()) == ("00:01:01", dt.date(1970, 1, 2), dt.datetime(1970, 1, 2, 0, 1, 1))


def test_joiners_in_quotes_join_nothing(spark):
    df = spark.createDataFrame([("a [and] b", 1), ("a", 2), ("it's [or]", 3)], "name string, n int")
    assert [r["n"] for r in filters.subset_filter(df, "name = 'a [and] b'").collect()] == [1]
    assert [r["n"] for r in filters.subset_filter(df, "name = 'a [and] b' [or] n > 1 [AND] name = 'it''s [or]'").collect()] == [1, 3]
