"""Column functions over text derived from the order, customer and document tables."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from quayside import functions as fn
from quayside.plans.registry import add, query

# Orders as text with the awkward values mixed in by status and priority. The texts are plain
# enough to mean the same in both engines.
TEXTS = """
  SELECT o_orderkey AS k,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN NULL
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN ''
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '3%' THEN '~'
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '4%' THEN ' '
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '1%' THEN concat(chr(9), 'tab ')
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '2%' THEN concat('  ', o_orderpriority, chr(10), ' ')
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '3%' THEN 'a'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '4%' THEN 'ab'
         WHEN o_orderstatus = 'O' THEN concat('order ', cast(o_orderkey AS STRING), ' of ', cast(o_custkey AS STRING), '      ')
         ELSE o_orderpriority END AS s,
    o_orderstatus AS status,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'Q' WHEN o_orderpriority LIKE '2%' THEN 'M'
         WHEN o_orderpriority LIKE '3%' THEN 'E' WHEN o_orderpriority LIKE '4%' THEN ''
         WHEN o_orderstatus = 'F' THEN NULL ELSE 'Z' END AS region
  FROM orders"""

DATES = """
  SELECT o_orderkey AS k,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN NULL
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN ''
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '3%' THEN '~'
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '4%' THEN '20220230'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '1%' THEN '2012/10/04'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '2%' THEN '20121004 x'
         ELSE replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', '') END AS ymd,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN NULL
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN ''
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '3%' THEN 'soon'
         ELSE substr(cast(o_orderdate AS STRING), 1, 10) END AS iso,
    CASE WHEN o_orderstatus = 'P' THEN NULL
         WHEN o_orderpriority LIKE '1%' THEN ''
         WHEN o_orderpriority LIKE '2%' THEN '0'
         WHEN o_orderpriority LIKE '3%' THEN 'not a time'
         ELSE concat(substr(cast(o_orderdate AS STRING), 1, 10), ' 0', substr(o_orderpriority, 1, 1), ':59:09') END AS stamp,
    concat(substr(cast(o_orderdate AS STRING), 6, 2),
           CASE WHEN o_orderstatus = 'F' THEN '/' ELSE 'B' END,
           CASE WHEN o_orderpriority LIKE '1%' THEN '41' ELSE substr(cast(o_orderdate AS STRING), 9, 2) END,
           CASE WHEN o_orderstatus = 'F' THEN '/' ELSE 'A' END,
           substr(cast(o_orderdate AS STRING), 1, 4), ' 22:34:31') AS us,
    substr(replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', ''), 3, 6) AS yymmdd
  FROM orders"""

NUMBERS = """
  SELECT o_orderkey AS k,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN NULL
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN ''
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '3%' THEN '12 3'
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '4%' THEN 'abc'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '1%' THEN '12a'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '2%' THEN '0'
         WHEN o_orderstatus = 'O' AND o_orderpriority LIKE '3%' THEN cast(o_custkey AS STRING)
         ELSE cast(cast(o_totalprice AS DECIMAL(18, 2)) AS STRING) END AS n,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '1%' THEN NULL
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN ''
         WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '3%' THEN 'abc'
         ELSE cast(o_custkey AS STRING) END AS i,
    CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE cast(o_custkey AS INT) END AS qty,
    o_custkey AS cust
  FROM orders"""

_RAW = {"texts": TEXTS, "dates": DATES, "numbers": NUMBERS}


def _scalar(name: str, raw: str, value, sql: str) -> None:
    """One function over one raw relation; ``sql`` is the DuckDB expression for the value."""
    add(
        name,
        lambda t: t.sql(_RAW[raw]).select("k", value().alias("v")),
        f"WITH raw AS ({_RAW[raw]}) SELECT k, {sql} AS v FROM raw",
    )


def _text(c):
    return c.cast("string")


_D = "CAST(CAST(try_strptime({}, '{}') AS DATE) AS VARCHAR)"
_T = "CAST(try_strptime({}, '{}') AS VARCHAR)"
_TRIM = r"regexp_replace({}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"

_scalar(
    "c1_case_when_map", "texts",
    lambda: fn.case_when_map("s", {"~": "none", "a": "short", "ab": None, "5-LOW": "later"}, "other"),
    "CASE s WHEN '~' THEN 'none' WHEN 'a' THEN 'short' WHEN 'ab' THEN NULL WHEN '5-LOW' THEN 'later' ELSE 'other' END",
)
_scalar("c2_empty_to_null_date", "dates", lambda: _text(fn.empty_to_null_date("iso")),
        _D.format("nullif(iso, '')", "%Y-%m-%d"))
_scalar("c3_empty_to_null", "texts", lambda: fn.empty_to_null("s"), "nullif(s, '')")
_scalar("c4_cast_as_date", "dates", lambda: _text(fn.cast_as_date("ymd", "yyyyMMdd")),
        _D.format("ymd", "%Y%m%d"))
_scalar(
    "c5_date_or_sentinel", "dates",
    lambda: _text(fn.date_or_sentinel("ymd", "~", "99991231", "yyyyMMdd")),
    _D.format("CASE WHEN ymd = '~' THEN '99991231' ELSE nullif(ymd, '') END", "%Y%m%d"),
)
_scalar("c6_nullif_to_timestamp", "dates",
        lambda: _text(fn.nullif_to_timestamp("stamp", "0", "yyyy-MM-dd HH:mm:ss")),
        _T.format("nullif(nullif(stamp, ''), '0')", "%Y-%m-%d %H:%M:%S"))
_scalar("c7_nullif_to_date", "dates", lambda: _text(fn.nullif_to_date("ymd", "~", "yyyyMMdd")),
        _D.format("nullif(nullif(ymd, ''), '~')", "%Y%m%d"))
add(
    "c8_now_if_empty",
    lambda t: t.sql(DATES).select(
        "k",
        F.concat(F.col("stamp"), F.lit(".250000")).alias("x"),
        (F.col("stamp").isNull() | (F.col("stamp") == "")).alias("took_now"),
    ).select("k", "took_now", F.when(~F.col("took_now"), _text(fn.now_if_empty("x"))).alias("v")),
    f"""WITH raw AS ({DATES})
        SELECT k, stamp IS NULL OR stamp = '' AS took_now,
               CASE WHEN NOT (stamp IS NULL OR stamp = '')
                    THEN CAST(try_strptime(stamp || '.250000', '%Y-%m-%d %H:%M:%S.%f') AS VARCHAR) END AS v
        FROM raw""",
)
_scalar("c9_to_timestamp_fmt", "dates", lambda: _text(fn.to_timestamp_fmt("stamp", "yyyy-MM-dd HH:mm:ss")),
        _T.format("stamp", "%Y-%m-%d %H:%M:%S"))
_scalar("c10_coalesce_char", "texts", lambda: fn.coalesce_char("s", 4, "unknown"),
        "left(coalesce(s, 'unknown'), 4)")
_scalar("c11_coalesce_timestamp", "dates",
        lambda: _text(fn.coalesce_timestamp("stamp", "9999-01-01 00:00:00")),
        "CAST(coalesce(try_strptime(nullif(stamp, ''), '%Y-%m-%d %H:%M:%S'), TIMESTAMP '9999-01-01 00:00:00') AS VARCHAR)")
_scalar("c12_coalesce_first", "texts", lambda: fn.coalesce_first("s", F.col("region"), "none"),
        "coalesce(s, region, 'none')")
add(
    "c13_coalesce_nullif",
    lambda t: t.sql(NUMBERS).select(
        "k",
        fn.coalesce_nullif("i", "7", 42, "bigint").alias("as_long"),
        fn.coalesce_nullif("i", "7", 42, "int").alias("as_int"),
        fn.coalesce_nullif("n", "0", 1.5, "double").alias("as_double"),
        fn.coalesce_nullif("i", "7", "none").alias("as_text"),
    ),
    f"""WITH raw AS ({NUMBERS})
        SELECT k,
          coalesce(TRY_CAST(coalesce(nullif(nullif(i, ''), '7'), '42') AS BIGINT), 0) AS as_long,
          coalesce(TRY_CAST(coalesce(nullif(nullif(i, ''), '7'), '42') AS INTEGER), 0) AS as_int,
          coalesce(TRY_CAST(coalesce(nullif(nullif(n, ''), '0'), '1.5') AS DOUBLE), 0.0) AS as_double,
          coalesce(nullif(nullif(i, ''), '7'), 'none') AS as_text
        FROM raw""",
)
_scalar("c14_coalesce_trim", "texts", lambda: fn.coalesce_trim("s", F.col("region"), "none"),
        f"coalesce({_TRIM.format('s')}, region, 'none')")
_scalar(
    "c15_decimal_cleanup", "numbers", lambda: fn.decimal_cleanup("n"),
    "CASE WHEN contains(trim(n), ' ') OR regexp_full_match(n, '[a-zA-Z]+') THEN -1.0::DOUBLE "
    "ELSE TRY_CAST(nullif(n, '') AS DOUBLE) END",
)
add(
    "c16_divide",
    lambda t: t.sql(NUMBERS).select(
        "k",
        fn.divide("qty", "n").alias("int_by_text"),
        fn.divide("n", F.lit("4"), "string").try_cast("double").alias("text_by_text"),
        fn.divide("qty", F.lit(8.0)).alias("text_by_double"),
        fn.divide("n", F.lit("0")).alias("by_zero"),
        fn.divide("qty", F.lit(3), "decimal(18,6)").cast("double").alias("as_decimal"),
    ),
    f"""WITH raw AS ({NUMBERS}), num AS (SELECT *, TRY_CAST(n AS DOUBLE) AS d FROM raw)
        SELECT k,
          CASE WHEN d <> 0 THEN CAST(qty AS DOUBLE) / d END AS int_by_text,
          d / 4 AS text_by_text,
          CAST(qty AS DOUBLE) / 8 AS text_by_double,
          CAST(NULL AS DOUBLE) AS by_zero,
          CAST(CAST(CAST(qty AS DOUBLE) / 3 AS DECIMAL(18, 6)) AS DOUBLE) AS as_decimal
        FROM num""",
)
add(
    "c17_file_name_part",
    lambda t: t.pages.select("page_id", fn.file_name_part("url", "dat").alias("v")),
    r"""SELECT page_id, coalesce(nullif(regexp_extract(
             list_extract(string_split(url, '/'), -1), '^[^.]*\.(.{3})', 1), ''), 'dat') AS v FROM pages""",
)
add(
    "c18_lit_typed",
    lambda t: t.sql(TEXTS).select(
        "k", fn.lit_typed("7", "int").alias("i"), fn.lit_typed(7, "bigint").alias("l"),
        fn.lit_typed("2.5", "double").alias("d"), fn.lit_typed("x", "string").alias("s"),
    ),
    f"WITH raw AS ({TEXTS}) SELECT k, 7::INTEGER AS i, 7::BIGINT AS l, 2.5::DOUBLE AS d, 'x' AS s FROM raw",
)
add(
    "c19_nullif_timestamp",
    lambda t: t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", _text(fn.nullif_timestamp("l_shipdate", "o_orderdate")).alias("v")
    ),
    """SELECT l_orderkey, l_linenumber, CAST(nullif(l_shipdate, o_orderdate) AS VARCHAR) AS v
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
_scalar("c20_empty_to_double", "numbers", lambda: fn.empty_to_double("n"), "TRY_CAST(nullif(n, '') AS DOUBLE)")
add(
    "c21_nullif",
    lambda t: t.sql(NUMBERS).select(
        "k", fn.nullif_text("i", "abc").alias("s"), fn.nullif_typed("cust", "7", "bigint").alias("l"),
        fn.nullif_typed("qty", "7", "int").alias("i"),
    ),
    f"""WITH raw AS ({NUMBERS}) SELECT k, nullif(nullif(i, ''), 'abc') AS s, nullif(cust, 7) AS l,
        nullif(qty, 7) AS i FROM raw""",
)
add(
    "c21_nullif_date",
    lambda t: t.orders.select(
        F.col("o_orderkey").alias("k"),
        _text(fn.nullif_typed(F.col("o_orderdate").cast("date"), "1997-05-28", "date")).alias("v"),
    ),
    "SELECT o_orderkey AS k, CAST(nullif(CAST(o_orderdate AS DATE), DATE '1997-05-28') AS VARCHAR) AS v FROM orders",
)
add(
    "c22_nvl_typed",
    lambda t: t.sql(NUMBERS).select(
        "k",
        fn.nvl_typed("n", 9.5, "double").alias("d"),
        fn.nvl_typed("n", "9.50", "decimal(18,2)").cast("double").alias("m"),
        fn.nvl_typed("i", 9, "bigint").alias("l"),
        fn.nvl_typed("i", 9, "int").alias("i"),
        fn.nvl_typed("i", 9.5, "float").cast("double").alias("f"),
        fn.nvl_typed("n", "none", "string").alias("s"),
    ),
    f"""WITH raw AS ({NUMBERS})
        SELECT k,
          CASE WHEN n IS NULL THEN 9.5::DOUBLE ELSE TRY_CAST(n AS DOUBLE) END AS d,
          CAST(CASE WHEN n IS NULL THEN 9.50::DECIMAL(18, 2) ELSE TRY_CAST(n AS DECIMAL(18, 2)) END AS DOUBLE) AS m,
          CASE WHEN i IS NULL THEN 9::BIGINT ELSE TRY_CAST(i AS BIGINT) END AS l,
          CASE WHEN i IS NULL THEN 9 ELSE TRY_CAST(i AS INTEGER) END AS i,
          CAST(CASE WHEN i IS NULL THEN 9.5::FLOAT ELSE TRY_CAST(i AS FLOAT) END AS DOUBLE) AS f,
          coalesce(n, 'none') AS s
        FROM raw""",
)
_scalar("c23_nvl_integer", "numbers", lambda: fn.nvl_integer("i", "11"),
        "CASE WHEN nullif(i, '') IS NULL THEN 11 ELSE TRY_CAST(i AS INTEGER) END")
_scalar("c24_nvl_trim", "texts", lambda: fn.nvl_trim("s", "none"), f"coalesce({_TRIM.format('s')}, 'none')")
_scalar("c25_zero_if_equal", "numbers", lambda: fn.zero_if_equal("qty", "7"),
        "CASE WHEN qty IS NULL OR qty = 7 THEN 0 ELSE qty END")
_scalar("c26_second_arg", "texts", lambda: fn.second_arg("s", "region"), "region")
_scalar("c27_us_timestamp", "dates", lambda: _text(fn.us_timestamp("us")),
        _T.format("concat(substr(us, 7, 4), '-', left(us, 2), '-', substr(us, 4, 2), substr(us, 11, 9))",
                  "%Y-%m-%d %H:%M:%S"))
_scalar("c28_prefixed_date", "dates", lambda: _text(fn.prefixed_date("yymmdd", "19", "yyyyMMdd")),
        _D.format("'19' || yymmdd", "%Y%m%d"))
_scalar("c29_right_after_rtrim", "texts", lambda: fn.right_after_rtrim("s", 3),
        r"right(regexp_replace(nullif(s, ''), '\s+$', ''), 3)")
_scalar("c30_java_substr", "texts", lambda: fn.java_substr("s", 1, 4),
        "CASE WHEN s = '' THEN '' WHEN length(s) >= 4 THEN substr(s, 2, 3) END")


def _near_now(at):
    """Whether a time lies within ten minutes of this process's own clock."""
    return F.abs(F.unix_seconds(at) - F.lit(int(time.time()))) < 600


add(
    "c31_today",
    lambda t: t.sql(TEXTS).select("k", fn.today().cast("string").alias("day"), fn.today_text().alias("shown")),
    f"WITH raw AS ({TEXTS}) SELECT k, CAST(CAST(now() AT TIME ZONE 'UTC' AS DATE) AS VARCHAR) AS day, day AS shown FROM raw",
)
add(
    "c32_time_text",
    lambda t: t.sql(TEXTS).select("k", _near_now(F.to_timestamp(F.concat(fn.today_text(), F.lit(" "), fn.time_text()))).alias("near")),
    f"WITH raw AS ({TEXTS}) SELECT k, true AS near FROM raw",
)
add(
    "c33_load_timestamp",
    lambda t: t.sql(TEXTS).select("k", _near_now(fn.load_timestamp("s")).alias("near")),
    f"WITH raw AS ({TEXTS}) SELECT k, true AS near FROM raw",
)
add(
    "c34_jtrim",
    lambda t: t.conversations.select("conv_id", "turn", fn.jtrim(F.concat(F.lit("\t "), "text", F.lit(" \n"))).alias("v")),
    f"SELECT conv_id, turn, {_TRIM.format('text')} AS v FROM conversations",
)
_scalar("c35_substr_replace_trim", "texts", lambda: fn.substr_replace_trim("s", 1, "-", " "),
        f"CASE WHEN s = '' THEN '' ELSE {_TRIM.format(chr(39).join(['replace(substr(s, 2), ', '-', ', ', ' ', ')']))} END")
add(
    "c36_regex_replace",
    lambda t: t.documents.select("doc_id", F.md5(fn.regex_replace("text", "([a-z]+)(ing|ed)", "$2$1")).alias("v")),
    r"SELECT doc_id, md5(regexp_replace(nullif(text, ''), '([a-z]+)(ing|ed)', '\2\1', 'g')) AS v FROM documents",
)
_scalar(
    "c37_region_code_map", "texts", lambda: fn.region_code("region"),
    "CASE region WHEN 'Q' THEN 'IL' WHEN 'M' THEN 'MI' WHEN 'G' THEN 'IN' WHEN 'J' THEN 'OH' WHEN 'E' THEN 'WI' "
    "ELSE CASE WHEN nullif(region, '') IS NOT NULL THEN '??' END END",
)
add(
    "c38_strip_non_ascii",
    lambda t: t.documents.select("doc_id", fn.strip_non_ascii("text").alias("v")),
    r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS v FROM documents",
)
_scalar("c39_mid_substr", "texts", lambda: fn.mid_substr("s"),
        "CASE WHEN length(s) >= 2 THEN substr(s, 2, least(length(s) - 1, 19) - 1) END")
_scalar("c40_concat_columns", "texts", lambda: fn.concat_columns("s", F.lit("|"), "region"), "s || '|' || region")
_scalar(
    "c41_case_when_map_int", "texts", lambda: fn.case_when_map("s", {"a": 1, "ab": 2, "5-LOW": 5}, 0),
    "CASE s WHEN 'a' THEN 1 WHEN 'ab' THEN 2 WHEN '5-LOW' THEN 5 ELSE 0 END",
)
_scalar(
    "c42_date_or_sentinel_ne", "dates",
    lambda: _text(fn.date_or_sentinel_ne("ymd", "20220230", "19990101", "yyyyMMdd")),
    _D.format("CASE WHEN ymd <> '20220230' AND ymd <> '' THEN '19990101' ELSE nullif(ymd, '') END", "%Y%m%d"),
)
_scalar("c43_blank_test", "texts", lambda: fn.blank_test("s"),
        r"trim(regexp_replace(s, '[\s\n]+', '', 'g')) = ''")
_scalar("c44_nvl_or_fallback", "numbers", lambda: fn.nvl_or_fallback(F.col("i").try_cast("int"), 0),
        "coalesce(TRY_CAST(i AS INTEGER), 0)")
add(
    "c45_hash_column",
    lambda t: t.documents.select("doc_id", fn.hash_column("text").alias("v")),
    "SELECT doc_id, sha256(text) AS v FROM documents",
)
add(
    "c46_sha1_id",
    lambda t: t.conversations.select("conv_id", "turn", fn.sha1_id("text").alias("v")),
    "SELECT conv_id, turn, sha1(text) AS v FROM conversations",
)


@query(
    "c47_iso_to_space_timestamp",
    "SELECT event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS v FROM events",
)
def _iso(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return t.events.select("event_id", fn.iso_to_space_timestamp(iso).alias("v"))
