"""Edge rows of the column functions, with results worked out by hand."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from quayside import functions as fn
from quayside.functions.temporal import DATE_MASKS, parse_date, parse_timestamp, translate_mask


def values(spark, rows, column, to=None):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    out = df.select("i", (column.cast(to) if to else column).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


D = dt.date
TS = dt.datetime


def cases():
    S = F.col("s")
    return [
        ("case_when_map", ["Q", "M", "x", None, ""], fn.case_when_map(S, {"Q": "IL", "M": None}, "??"), ["IL", None, "??", "??", "??"]),
        ("empty_to_null", [None, "", " ", "a"], fn.empty_to_null(S), [None, None, " ", "a"]),
        ("empty_to_null_date", [None, "", "2022-02-19", "2022-02-30", "20220219"], fn.empty_to_null_date(S), [None, None, D(2022, 2, 19), None, None]),
        ("cast_as_date", ["2012/10/04", "2012/10/04 x", "", None, "2012/1/4"], fn.cast_as_date(S, "yyyy/MM/dd"), [D(2012, 10, 4), None, None, None, None]),
        ("date_or_sentinel", ["~", "20220219", "20220230", "", None], fn.date_or_sentinel(S, "~", "99991231", "yyyyMMdd"), [D(9999, 12, 31), D(2022, 2, 19), None, None, None]),
        ("date_or_sentinel_ne", ["~", "20220219", ""], fn.date_or_sentinel_ne(S, "20220219", "19990101", "yyyyMMdd"), [D(1999, 1, 1), D(2022, 2, 19), None]),
        ("nullif_to_date", ["0", "20220219", "bad"], fn.nullif_to_date(S, "0", "yyyyMMdd"), [None, D(2022, 2, 19), None]),
        ("nullif_to_timestamp", ["0", "2022-10-20 00:00:56", ""], fn.nullif_to_timestamp(S, "0", "yyyy-MM-dd HH:mm:ss"), [None, TS(2022, 10, 20, 0, 0, 56), None]),
        ("to_timestamp_fmt", ["20221020 235959", "20221020 245959", None], fn.to_timestamp_fmt(S, "yyyyMMdd HHmmss"), [TS(2022, 10, 20, 23, 59, 59), None, None]),
        ("coalesce_char", ["abcdef", "ab", None], fn.coalesce_char(S, 4, "unknown"), ["abcd", "ab", "unkn"]),
        ("coalesce_timestamp", ["2022-10-20 00:00:56", "", "junk"], fn.coalesce_timestamp(S, "9999-01-01 00:00:00"), [TS(2022, 10, 20, 0, 0, 56), TS(9999, 1, 1), TS(9999, 1, 1)]),
        ("coalesce_first", [None, "a", ""], fn.coalesce_first(S, "d"), ["d", "a", ""]),
        ("coalesce_nullif_long", ["7", "", None, "12a", "5"], fn.coalesce_nullif(S, "7", 42, "bigint"), [42, 42, 42, 0, 5]),
        ("coalesce_nullif_double", ["abc", "1.5", "7"], fn.coalesce_nullif(S, "7", 2.5, "double"), [0.0, 1.5, 2.5]),
        ("coalesce_nullif_text", ["7", "", "a"], fn.coalesce_nullif(S, "7", "n"), ["n", "n", "a"]),
        ("coalesce_trim", ["\ta ", None, ""], fn.coalesce_trim(S, " d "), ["a", " d ", ""]),
        ("decimal_cleanup", ["600.2", "12 3", "abc", "12a", "", None, " 5 "], fn.decimal_cleanup(S), [600.2, -1.0, -1.0, None, None, None, 5.0]),
        ("divide", ["234", "0", "x", None, "1"], fn.divide(S, F.lit("4")), [58.5, 0.0, None, None, 0.25]),
        ("divide by zero", ["234"], fn.divide(S, F.lit("0")), [None]),
        ("empty_to_double", ["", "1e3", "600.2", "x"], fn.empty_to_double(S), [None, 1000.0, 600.2, None]),
        ("nullif_text", ["", "a", "b", None], fn.nullif_text(S, "a"), [None, None, "b", None]),
        ("nvl_typed int", [None, "", "5", "5.5", "x"], fn.nvl_typed(S, 9, "int"), [9, None, 5, None, None]),
        ("nvl_typed decimal", [None, "1.25", "x"], fn.nvl_typed(S, "9.50", "decimal(10,2)"), [decimal.Decimal("9.50"), decimal.Decimal("1.25"), None]),
        ("nvl_integer", [None, "", "5", "x"], fn.nvl_integer(S, "11"), [11, 11, 5, None]),
        ("nvl_trim", [None, " a\n"], fn.nvl_trim(S, "d"), ["d", "a"]),
        ("zero_if_equal", ["7", None, "8"], fn.zero_if_equal(S.cast("int"), "7"), [0, 0, 8]),
        ("us_timestamp", ["09/03/2022 22:34:31", "09B11A2024 22:59:09", "9/3/2022 22:34:31", "13/01/2022 00:00:00"], fn.us_timestamp(S), [TS(2022, 9, 3, 22, 34, 31), TS(2024, 9, 11, 22, 59, 9), None, None]),
        ("prefixed_date", ["200405", "", None, "991332"], fn.prefixed_date(S, "20", "yyyyMMdd"), [D(2020, 4, 5), None, None, None]),
        ("right_after_rtrim", ["abcde      ", "ab", "", None, "  "], fn.right_after_rtrim(S, 3), ["cde", "ab", None, None, ""]),
        ("java_substr", ["AYDITYA", "A", "", None], fn.java_substr(S, 0, 2), ["AY", None, "", None]),
        ("java_substr reversed", ["AYDITYA"], fn.java_substr(S, 3, 2), [None]),
        ("jtrim", ["\ttab ", "\n", " a b ", None, " x"], fn.jtrim(S), ["tab", "", "a b", None, " x"]),
        ("substr_replace_trim", ["xa-b ", "", None, "x"], fn.substr_replace_trim(S, 1, "-", ""), ["ab", "", None, ""]),
        ("regex_replace", ["a1b22", "", None], fn.regex_replace(S, r"([a-z])(\d)", "$2$1"), ["1a2b2", None, None]),
        ("region_code", ["Q", "M", "G", "J", "E", "Z", "", None], fn.region_code(S), ["IL", "MI", "IN", "OH", "WI", "??", None, None]),
        ("strip_non_ascii", ["naïve ☃", None], fn.strip_non_ascii(S), ["nave ", None]),
        ("mid_substr", ["", "a", "ab", "abc", "x" + "y" * 19, "x" + "y" * 20], fn.mid_substr(S), [None, None, "", "b", "y" * 18, "y" * 18]),
        ("blank_test", [" ", "\t\n", "", "a", None], fn.blank_test(S), [True, True, True, False, None]),
        ("file_name_part", ["/a/b.dat.gz", "plain", "x.ab"], fn.file_name_part(S, "dfl"), ["dat", "dfl", "dfl"]),
        ("iso", ["2024-01-01T01:02:03.4Z", "2024-01-01T01:02:03"], fn.iso_to_space_timestamp(S), ["2024-01-01 01:02:03", "2024-01-01 01:02:03"]),
        ("concat", ["a", None], fn.concat_columns(S, F.lit("-"), S), ["a-a", None]),
    ]


def test_edge_rows(spark):
    wrong = {}
    for name, rows, column, expected in cases():
        got = values(spark, rows, column)
        if got != expected:
            wrong[name] = (got, expected)
    assert not wrong


def test_now_if_empty_keeps_bad_text_null(spark):
    S = F.col("s")
    out = values(spark, ["", None, "2022-10-20 00:00:56.250000", "bad"], fn.now_if_empty(S))
    assert out[0] is not None and out[1] is not None
    assert out[2] == TS(2022, 10, 20, 0, 0, 56, 250000)
    assert out[3] is None


def test_nullif_typed(spark):
    df = spark.sql("SELECT * FROM VALUES (7, DATE'1997-05-28'), (8, DATE'1997-05-29'), (NULL, NULL) AS v(n, d)")
    out = df.select(fn.nullif_typed("n", "7", "int"), fn.nullif_typed("d", "1997-05-28", "date")).collect()
    assert [tuple(r) for r in out] == [(None, None), (8, D(1997, 5, 29)), (None, None)]


def test_large_map_equals_case(spark):
    S = F.col("s")
    pairs = {f"k{i}": i for i in range(60)}
    rows = ["k0", "k59", "none", None]
    assert values(spark, rows, fn.case_when_map(S, pairs, -1)) == [0, 59, -1, -1]


def test_fixed_masks_agree_with_the_general_parser(spark):
    S = F.col("s")
    rows = ["2022-02-19", "2022-02-30", "2022-2-19", "x", "", None, "0001-01-01", "2022-02-19 ", "+2022-02-19"]
    general = F.try_to_timestamp(S, F.lit("yyyy-MM-dd")).cast("date")
    assert values(spark, rows, parse_date(S, "yyyy-MM-dd")) == values(spark, rows, general)
    stamps = ["2022-10-20 00:00:56", "2022-10-20 24:00:00", "2022-10-20 23:60:00", "2022-10-20", "2022-10-20 1:2:3"]
    general = F.try_to_timestamp(S, F.lit("yyyy-MM-dd HH:mm:ss"))
    assert values(spark, stamps, parse_timestamp(S)) == values(spark, stamps, general)


@pytest.mark.parametrize("legacy,text,expected", [
    ("yyyy/mm/ddbhh:mi:ss", "2022/10/20 01:02:03", TS(2022, 10, 20, 1, 2, 3)),
    ("mmddyyyy", "10202022", TS(2022, 10, 20)),
    ("e3bmmmbddbyybhh:mi:ss", "Thu Oct 20 2022 01:02:03", TS(2022, 10, 20, 1, 2, 3)),
    ("yyyymmddhhmissds(6)", "20221020010203.250000", TS(2022, 10, 20, 1, 2, 3, 250000)),
    ("yyyy-mm-ddbhh:mi:ss.s(6)", "2022-10-20 01:02:03.250Z", TS(2022, 10, 20, 1, 2, 3, 250000)),
    ("dd-mmm-yyyy", "20-Oct-2022", TS(2022, 10, 20)),
    ("yyyymm", "202210", TS(2022, 10, 1)),
    ("hh:mi", "01:02", TS(1970, 1, 1, 1, 2)),
    ("d/m/yyyy h:m", "3/4/2022 1:2", TS(2022, 4, 3, 1, 2)),
])
def test_legacy_masks(spark, legacy, text, expected):
    S = F.col("s")
    assert legacy in DATE_MASKS
    assert values(spark, [text, "junk"], parse_timestamp(S, translate_mask(legacy))) == [expected, None]


def test_sql_functions_match_columns(spark):
    S = F.col("s")
    names = fn.register_sql_functions(spark, "q_")
    assert len(names) == len(set(names))
    rows = [None, "", " ", "\ttab ", "abcde   ", "600.2", "12 3", "7", "20220219", "Q", "naïve", "~"]
    spark.createDataFrame([(r,) for r in rows], "s string").createOrReplaceTempView("edge")
    pairs = {
        "q_jtrim(s)": fn.jtrim(S), "q_empty_to_null(s)": fn.empty_to_null(S), "q_decimal_cleanup(s)": fn.decimal_cleanup(S),
        "q_java_substr(s, 0, 2)": fn.java_substr(S, 0, 2), "q_mid_substr(s)": fn.mid_substr(S),
        "q_nvl_integer(s, '11')": fn.nvl_integer(S, "11"), "q_region_code(s)": fn.region_code(S),
        "q_cast_as_date(s, 'yyyyMMdd')": fn.cast_as_date(S, "yyyyMMdd"), "q_divide(s, '4')": fn.divide(S, F.lit("4")),
        "q_date_or_sentinel(s, '~', '99991231', 'yyyyMMdd')": fn.date_or_sentinel(S, "~", "99991231", "yyyyMMdd"),
        "q_right_after_rtrim(s, 3)": fn.right_after_rtrim(S, 3), "q_strip_non_ascii(s)": fn.strip_non_ascii(S),
        "q_blank_test(s)": fn.blank_test(S), "q_coalesce_char(s, 2, 'dd')": fn.coalesce_char(S, 2, "dd"),
        "q_substr_replace_trim(s, 1, 'a', '')": fn.substr_replace_trim(S, 1, "a", ""), "q_hash_column(s)": fn.hash_column(S),
        "q_case_when_map(s, map('Q', 'x', '~', NULL), 'else')": fn.case_when_map(S, {"Q": "x", "~": None}, "else"),
        "q_case_when_map_int(s, map('Q', 1), 0)": fn.case_when_map(S, {"Q": 1}, 0),
        "q_date_or_sentinel_ne(s, '20220219', '20200101', 'yyyyMMdd')": fn.date_or_sentinel_ne(S, "20220219", "20200101", "yyyyMMdd"),
        "q_coalesce_timestamp(s, '2020-01-01 00:00:00', 'yyyy-MM-dd HH:mm:ss')": fn.coalesce_timestamp(S, "2020-01-01 00:00:00"),
        "q_nullif_timestamp(TIMESTAMP'2020-01-01', TIMESTAMP'2020-01-01')": fn.nullif_timestamp(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp")),
        "q_coalesce_first(s, 'd')": fn.coalesce_first(S, "d"), "q_nvl_or_fallback(s, 'd')": fn.nvl_or_fallback(S, "d"),
        "q_second_arg('a', s)": fn.second_arg("s", "s"), "q_concat_columns(s, '-', s)": fn.concat_columns("s", F.lit("-"), "s"),
        "q_file_name_part(concat('/a/', s, '.csv'), 'no')": fn.file_name_part(F.concat(F.lit("/a/"), S, F.lit(".csv")), "no"),
        "q_today()": fn.today(), "q_today_text()": fn.today_text(),
        "q_nvl_long(s, 5)": fn.nvl_typed(S, 5, "bigint"), "q_nvl_double(s, 0.5D)": fn.nvl_typed(S, 0.5, "double"),
        "q_nvl_decimal(s, 2)": fn.nvl_typed(S, 2, "decimal(38,18)"),
        "q_nullif_int(try_cast(s AS INT), '7')": fn.nullif_typed(S.try_cast("int"), "7", "int"),
        "q_nullif_double(try_cast(s AS DOUBLE), '600.2')": fn.nullif_typed(S.try_cast("double"), "600.2", "double"),
        "q_coalesce_nullif_int(s, '7', 3)": fn.coalesce_nullif(S, "7", 3, "int"),
        "q_coalesce_nullif_double(s, '7', 3)": fn.coalesce_nullif(S, "7", 3.0, "double"),
    }
    assert spark.sql("SELECT q_time_text() = date_format(q_load_timestamp(), 'HH:mm:ss') AND q_now_if_empty('', 'yyyy') = q_load_timestamp()").first()[0]
    for text, column in pairs.items():
        by_name = [r[0] for r in spark.sql(f"SELECT {text} FROM edge").collect()]
        assert by_name == [r[0] for r in spark.table("edge").select(column).collect()], text


def test_a_long_map_is_read_as_a_short_one(spark):
    pairs = {f"k{i}": i for i in range(45)} | {None: 99}
    df = spark.createDataFrame([("k1",), ("k44",), (None,), ("x",), ("",)], "c string")
    for some in (pairs, {k: pairs[k] for k in ("k1", "k44", None)}):
        assert [r[0] for r in df.select(fn.case_when_map("c", some, -1)).collect()] == [1, 44, -1, -1, -1]


def test_decimals_are_divided_as_decimals(spark):
    df = spark.sql("SELECT CAST('12345678901234567890' AS DECIMAL(38,6)) AS a, CAST(1 AS DECIMAL(38,6)) AS b, 'x' AS t")
    row = df.select(fn.divide("a", "b", "decimal(38,6)"), fn.divide("t", "b", "decimal(38,6)"), fn.divide("a", F.lit(0), "decimal(38,6)")).first()
    assert str(row[0]) == "12345678901234567890.000000" and row[1] is None and row[2] is None
