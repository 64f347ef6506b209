"""Null, empty-string and default handling.

Functions differ on purpose in whether '' counts as missing; each docstring says which.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.numbers import read_as
from quayside.functions.text import _col, jtrim

# Region letters and their codes.
REGION_CODES = {"Q": "IL", "M": "MI", "G": "IN", "J": "OH", "E": "WI"}
REGION_UNKNOWN = "??"


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def empty_to_null(c, _unused=None) -> Column:
    """'' becomes null, everything else stays."""
    return blank_to_null(c)


def case_when_map(c, pairs: Mapping, default=None) -> Column:
    """Value of the first key equal to ``c``; ``default`` on a miss and for null. A null key equals nothing."""
    c = _col(c)
    fallback = F.lit(default)
    if not pairs:
        return fallback
    result = None
    for key, value in pairs.items():
        branch = (c == F.lit(key), F.lit(value))
        result = F.when(*branch) if result is None else result.when(*branch)
    return result.otherwise(fallback)


def region_code(c) -> Column:
    c = blank_to_null(c)
    return F.when(c.isNotNull(), case_when_map(c, REGION_CODES, REGION_UNKNOWN))


def coalesce_first(c, *defaults) -> Column:
    return F.coalesce(_col(c), *[d if isinstance(d, Column) else F.lit(d) for d in defaults])


def coalesce_char(c, n: int, default: str) -> Column:
    """First ``n`` characters of the value or, when null, of the default."""
    return F.left(coalesce_first(c, default), F.lit(n))


def coalesce_trim(c, *defaults) -> Column:
    """Trimmed value, else the first non-null default (untrimmed)."""
    return coalesce_first(jtrim(c), *defaults)


def nvl_trim(c, default: str) -> Column:
    return coalesce_trim(c, default)


def nullif_text(c, value: str) -> Column:
    """'' and ``value`` become null."""
    return F.nullif(blank_to_null(c), F.lit(value))


def nullif_typed(c, value: str, to: str) -> Column:
    """Number or date equal to ``value`` becomes null."""
    c = _col(c)
    return F.when(F.equal_null(c, F.lit(value).try_cast(to)), None).otherwise(c)


def coalesce_nullif(c, value: str, default, to: str | None = None) -> Column:
    """'' / ``value`` / null take ``default``; text that does not parse as ``to`` gives zero."""
    text = F.coalesce(nullif_text(c, value), F.lit(None if default is None else str(default)))
    if to is None:
        return text
    return F.coalesce(read_as(text, to), F.lit(0).cast(to))


def nvl_typed(c, default, to: str) -> Column:
    """Null takes the default; bad text stays null so that it shows up as a reject."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(default).cast(to)).otherwise(read_as(c, to))


def nvl_integer(c, default: str) -> Column:
    """As ``nvl_typed`` for integers, but '' counts as missing too."""
    return nvl_typed(blank_to_null(c), default, "int")


def nvl_or_fallback(expr, fallback) -> Column:
    """Two-argument form used by legacy specs: the expression, else a typed fallback."""
    return coalesce_first(expr, fallback)


def zero_if_equal(c, value) -> Column:
    """Null and ``value`` become zero."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit(value).cast("int")), F.lit(0)).otherwise(c)


def second_arg(_first, second) -> Column:
    return _col(second)


def blank_test(c) -> Column:
    """True when nothing but whitespace is left; null stays null."""
    return F.trim(F.regexp_replace(_col(c), r"[\s\n]+", "")) == ""
