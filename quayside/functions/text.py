"""Trimming, cutting, replacing and hashing of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which characters count as blank or as plain text.
EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"
TRAILING_SPACE = r"\s+$"
NON_ASCII = r"[^\x00-\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """Strip every character up to U+0020 from both ends (Spark's ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), EDGE_BLANKS, "")


def java_substr(c, start: int, end: int) -> Column:
    """Zero-based half-open substring. Null and '' come back unchanged; out of range is null."""
    c = _col(c)
    if not 0 <= start <= end:
        cut = F.lit(None).cast("string")
    else:
        cut = F.when(F.length(c) >= end, F.substring(c, start + 1, end - start))
    return F.when(c.isNull() | (c == ""), c).otherwise(cut)


def mid_substr(c) -> Column:
    """Characters 1 up to min(length - 1, 19), zero-based; null below two characters."""
    c = _col(c)
    size = F.least(F.length(c) - 1, F.lit(19)) - 1
    return F.when(F.length(c) >= 2, c.substr(F.lit(2), size))


def right_after_rtrim(c, n: int) -> Column:
    """Last ``n`` characters once trailing whitespace is gone; '' and null give null."""
    c = F.nullif(_col(c), F.lit(""))
    return F.right(F.regexp_replace(c, TRAILING_SPACE, ""), F.lit(n))


def substr_replace_trim(c, begin: int, find: str, repl: str) -> Column:
    """Cut from ``begin`` (zero-based), replace literally, then trim. '' and null unchanged."""
    c = _col(c)
    tail = c.substr(F.lit(begin + 1), F.length(c))
    swapped = F.replace(tail, F.lit(find), F.lit(repl))
    return F.when(c.isNull() | (c == ""), c).otherwise(jtrim(swapped))


def regex_replace(c, pattern: str, repl: str) -> Column:
    """Replace every match; '' and null give null."""
    return F.regexp_replace(F.nullif(_col(c), F.lit("")), pattern, repl)


def strip_non_ascii(c) -> Column:
    return F.regexp_replace(_col(c), NON_ASCII, "")


def concat_columns(*parts) -> Column:
    """Concatenate columns and literals (``F.lit``); any null makes the result null."""
    return F.concat(*[_col(p) for p in parts])


def file_name_part(path, default: str) -> Column:
    """The three characters after the first dot of a file name, else ``default``.

    ``path`` is usually ``_metadata.file_name``.
    """
    name = F.substring_index(_col(path), "/", -1)
    part = F.regexp_extract(name, r"^[^.]*\.(.{3})", 1)
    return F.coalesce(F.nullif(part, F.lit("")), F.lit(default))


def hash_column(c, bits: int = 256) -> Column:
    """SHA-2 digest of the value as text: the same on every engine, unlike ``hash``."""
    return F.sha2(_col(c).cast("string"), bits)


def sha1_id(c) -> Column:
    return F.sha1(_col(c).cast("string"))
