"""Column functions for values that arrive as text. All are native Spark expressions."""

from quayside.functions.empties import (
    blank_to_null,
    blank_test,
    case_when_map,
    coalesce_char,
    coalesce_first,
    coalesce_nullif,
    coalesce_trim,
    empty_to_null,
    nullif_text,
    nullif_typed,
    nvl_integer,
    nvl_or_fallback,
    nvl_trim,
    nvl_typed,
    region_code,
    second_arg,
    zero_if_equal,
)
from quayside.functions.numbers import decimal_cleanup, divide, empty_to_double, lit_typed, read_as
from quayside.functions.sqlnames import register_sql_functions
from quayside.functions.temporal import (
    cast_as_date,
    coalesce_timestamp,
    date_or_sentinel,
    date_or_sentinel_ne,
    empty_to_null_date,
    iso_to_space_timestamp,
    load_timestamp,
    now_if_empty,
    nullif_timestamp,
    nullif_to_date,
    nullif_to_timestamp,
    prefixed_date,
    time_text,
    to_timestamp_fmt,
    today,
    today_text,
    us_timestamp,
)
from quayside.functions.text import (
    concat_columns,
    file_name_part,
    hash_column,
    java_substr,
    jtrim,
    mid_substr,
    regex_replace,
    right_after_rtrim,
    sha1_id,
    strip_non_ascii,
    substr_replace_trim,
)

__all__ = [name for name in dir() if not name.startswith("_")]
