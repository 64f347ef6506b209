"""The column functions under the same names in SQL.

They are SQL functions: Spark inlines their bodies, so a query that calls one is planned as if the
expression had been written out. Masks and patterns must be literals in the call.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_TRIM = r"regexp_replace({}, r'^[\x00-\x20]+|[\x00-\x20]+$', '')"
_WHOLE_SHAPE = r"r'^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$'"
_FRACTION_SHAPE = r"r'^[\x00-\x20]*[+-]?([0-9.][0-9.eE+-]*[dDfF]?|(?i:nan|inf|infinity))[\x00-\x20]*$'"
_WHOLE = "rlike({0}, " + _WHOLE_SHAPE.replace("{", "{{").replace("}", "}}") + ")"
_FRACTION = "rlike({0}, " + _FRACTION_SHAPE.replace("{", "{{").replace("}", "}}") + ")"

# name: (parameters, result type, body)
SQL_FUNCTIONS = {
    "empty_to_null": ("s STRING", "STRING", "nullif(s, '')"),
    "empty_to_null_date": ("s STRING", "DATE", "try_to_date(nullif(s, ''), 'yyyy-MM-dd')"),
    "cast_as_date": ("s STRING, mask STRING", "DATE", "try_to_date(nullif(s, ''), mask)"),
    "date_or_sentinel": (
        "s STRING, sentinel STRING, alternative STRING, mask STRING", "DATE",
        "try_to_date(CASE WHEN s = sentinel THEN alternative ELSE nullif(s, '') END, mask)"),
    "nullif_to_date": ("s STRING, v STRING, mask STRING", "DATE", "try_to_date(nullif(nullif(s, ''), v), mask)"),
    "nullif_to_timestamp": (
        "s STRING, v STRING, mask STRING", "TIMESTAMP", "try_to_timestamp(nullif(nullif(s, ''), v), mask)"),
    "to_timestamp_fmt": ("s STRING, mask STRING", "TIMESTAMP", "try_to_timestamp(nullif(s, ''), mask)"),
    "prefixed_date": ("s STRING, prefix STRING, mask STRING", "DATE", "try_to_date(concat(prefix, nullif(s, '')), mask)"),
    "coalesce_char": ("s STRING, n INT, d STRING", "STRING", "left(coalesce(s, d), n)"),
    "coalesce_trim": ("s STRING, d STRING", "STRING", f"coalesce({_TRIM.format('s')}, d)"),
    "nvl_trim": ("s STRING, d STRING", "STRING", f"coalesce({_TRIM.format('s')}, d)"),
    "jtrim": ("s STRING", "STRING", _TRIM.format("s")),
    "nullif_text": ("s STRING, v STRING", "STRING", "nullif(nullif(s, ''), v)"),
    "coalesce_nullif": ("s STRING, v STRING, d STRING", "STRING", "coalesce(nullif(nullif(s, ''), v), d)"),
    "nvl_integer": (
        "s STRING, d STRING", "INT",
        f"CASE WHEN nullif(s, '') IS NULL THEN cast(d AS INT) WHEN {_WHOLE.format('s')} THEN try_cast(s AS INT) END"),
    "zero_if_equal": ("n INT, v INT", "INT", "CASE WHEN n IS NULL OR n = v THEN 0 ELSE n END"),
    "decimal_cleanup": (
        "s STRING", "DOUBLE",
        "CASE WHEN contains(trim(s), ' ') OR rlike(s, '^[a-zA-Z]+$') THEN -1.0D ELSE try_cast(nullif(s, '') AS DOUBLE) END"),
    "divide": ("a STRING, b STRING", "DOUBLE", "try_divide(try_cast(a AS DOUBLE), try_cast(b AS DOUBLE))"),
    "empty_to_double": ("s STRING", "DOUBLE", "try_cast(nullif(s, '') AS DOUBLE)"),
    "right_after_rtrim": ("s STRING, n INT", "STRING", r"right(regexp_replace(nullif(s, ''), r'\s+$', ''), n)"),
    "java_substr": (
        "s STRING, b INT, e INT", "STRING",
        "CASE WHEN s IS NULL OR s = '' THEN s WHEN b >= 0 AND b <= e AND e <= length(s) THEN substring(s, b + 1, e - b) END"),
    "substr_replace_trim": (
        "s STRING, b INT, f STRING, r STRING", "STRING",
        f"CASE WHEN s IS NULL OR s = '' THEN s ELSE {_TRIM.format('replace(substring(s, b + 1), f, r)')} END"),
    "regex_replace": ("s STRING, p STRING, r STRING", "STRING", "regexp_replace(nullif(s, ''), p, r)"),
    "strip_non_ascii": ("s STRING", "STRING", r"regexp_replace(s, r'[^\x00-\x7F]', '')"),
    "mid_substr": (
        "s STRING", "STRING", "CASE WHEN length(s) >= 2 THEN substring(s, 2, least(length(s) - 1, 19) - 1) END"),
    "region_code": (
        "s STRING", "STRING",
        "CASE WHEN nullif(s, '') IS NULL THEN NULL WHEN s = 'Q' THEN 'IL' WHEN s = 'M' THEN 'MI' WHEN s = 'G' THEN 'IN' "
        "WHEN s = 'J' THEN 'OH' WHEN s = 'E' THEN 'WI' ELSE '??' END"),
    "blank_test": ("s STRING", "BOOLEAN", r"trim(regexp_replace(s, r'[\s\n]+', '')) = ''"),
    "hash_column": ("s STRING", "STRING", "sha2(s, 256)"),
    "sha1_id": ("s STRING", "STRING", "sha1(s)"),
    "iso_to_space_timestamp": ("s STRING", "STRING", "replace(substring_index(s, '.', 1), 'T', ' ')"),
    "us_timestamp": (
        "s STRING", "TIMESTAMP",
        "try_to_timestamp(concat(substring(s, 7, 4), '-', left(s, 2), '-', substring(s, 4, 2), substring(s, 11, 9)), "
        "'yyyy-MM-dd HH:mm:ss')"),
    "case_when_map": (
        "s STRING, pairs MAP<STRING, STRING>, d STRING", "STRING",
        "CASE WHEN s IS NOT NULL AND map_contains_key(pairs, s) THEN try_element_at(pairs, s) ELSE d END"),
    "case_when_map_int": (
        "s STRING, pairs MAP<STRING, INT>, d INT", "INT",
        "CASE WHEN s IS NOT NULL AND map_contains_key(pairs, s) THEN try_element_at(pairs, s) ELSE d END"),
    "date_or_sentinel_ne": (
        "s STRING, sentinel STRING, other STRING, mask STRING", "DATE",
        "try_to_date(CASE WHEN nullif(s, '') <> sentinel THEN other ELSE nullif(s, '') END, mask)"),
    "now_if_empty": (
        "s STRING, mask STRING", "TIMESTAMP",
        "CASE WHEN nullif(s, '') IS NULL THEN current_timestamp() ELSE try_to_timestamp(nullif(s, ''), mask) END"),
    "coalesce_timestamp": (
        "s STRING, d STRING, mask STRING", "TIMESTAMP",
        "coalesce(try_to_timestamp(nullif(s, ''), mask), try_to_timestamp(d, mask))"),
    "nullif_timestamp": ("a TIMESTAMP, b TIMESTAMP", "TIMESTAMP", "nullif(a, b)"),
    "coalesce_first": ("s STRING, d STRING", "STRING", "coalesce(s, d)"),
    "nvl_or_fallback": ("s STRING, d STRING", "STRING", "coalesce(s, d)"),
    "second_arg": ("a STRING, b STRING", "STRING", "b"),
    "concat_columns": ("a STRING, b STRING, c STRING", "STRING", "concat(a, b, c)"),
    "file_name_part": (
        "path STRING, d STRING", "STRING",
        r"coalesce(nullif(regexp_extract(substring_index(path, '/', -1), r'^[^.]*\.(.{3})', 1), ''), d)"),
    "today": ("", "DATE", "current_date()"),
    "today_text": ("", "STRING", "date_format(current_date(), 'yyyy-MM-dd')"),
    "time_text": ("", "STRING", "date_format(current_timestamp(), 'HH:mm:ss')"),
    "load_timestamp": ("", "TIMESTAMP", "current_timestamp()"),
    **{
        f"nvl_{kind}": (
            f"s STRING, d {sql}", sql, f"CASE WHEN s IS NULL THEN d WHEN {shape.format('s')} THEN try_cast(s AS {sql}) END")
        for kind, sql, shape in (
            ("long", "BIGINT", _WHOLE), ("double", "DOUBLE", _FRACTION), ("decimal", "DECIMAL(38,18)", _FRACTION))
    },
    **{
        f"nullif_{kind}": (f"n {sql}, v STRING", sql, f"CASE WHEN n <=> try_cast(v AS {sql}) THEN NULL ELSE n END")
        for kind, sql in (("int", "INT"), ("long", "BIGINT"), ("double", "DOUBLE"), ("date", "DATE"))
    },
    **{
        f"coalesce_nullif_{kind}": (
            f"s STRING, v STRING, d {sql}", sql,
            f"coalesce(try_cast(CASE WHEN rlike(coalesce(nullif(nullif(s, ''), v), cast(d AS STRING)), {shape}) "
            f"THEN coalesce(nullif(nullif(s, ''), v), cast(d AS STRING)) END AS {sql}), cast(0 AS {sql}))")
        for kind, sql, shape in (("int", "INT", _WHOLE_SHAPE), ("double", "DOUBLE", _FRACTION_SHAPE))
    },
}


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the functions callable from SQL in this session; ``prefix`` avoids name clashes."""
    names = []
    for name, (params, result, body) in SQL_FUNCTIONS.items():
        full = f"{prefix}{name}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {full}({params}) RETURNS {result} RETURN {body}")
        names.append(full)
    return names
