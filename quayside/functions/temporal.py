"""Date and timestamp parsing. Parsing is strict: text that does not fit the mask gives null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import _col

# Legacy masks and the masks they stand for here.
DATE_MASKS = {
    "yyyy-mm-dd": "yyyy-MM-dd",
    "mm/dd/yyyy": "MM/dd/yyyy",
    "hh:mi": "HH:mm",
    "yyyy/mm/ddbhh:mi:ss": "yyyy/MM/dd HH:mm:ss",
    "mm/dd/yyyybhh:mi:ss": "MM/dd/yyyy HH:mm:ss",
    "mmddyyyy": "MMddyyyy",
    "yyyy/mm/dd": "yyyy/MM/dd",
    "dd-mon-yy": "dd-MMM-yy",
    "e3bmmmbddbyybhh:mi:ss": "EEE MMM dd yyyy HH:mm:ss",
    "yyyymmdd": "yyyyMMdd",
    "dd-mmm-yy": "dd-MMM-yy",
    "d/m/yyyy h:m:s": "d/M/yyyy H:m:s",
    "d/m/yyyy h:m": "d/M/yyyy H:m",
    "hh:mi:ss": "HH:mm:ss",
    "yyyy-mm-ddbhh:mi:ss.s(6)": "yyyy-MM-dd HH:mm:ss.SSS'Z'",
    "yyyy-mm-ddbhh:mi:ss.s(0)": "yyyy-MM-dd HH:mm:ss",
    "yyyymm": "yyyyMM",
    "yyyymmddhhmissds(6)": "yyyyMMddHHmmss.SSSSSS",
    "dd-mmm-yyyy": "dd-MMM-yyyy",
}
ISO_DATE = "yyyy-MM-dd"
ISO_SECONDS = "yyyy-MM-dd HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
WEEKDAY = "EEE "


def translate_mask(mask: str) -> str:
    """Legacy date mask to Spark mask; a mask that is already Spark's passes through."""
    return DATE_MASKS.get(mask.strip().lower(), mask) if mask not in DATE_MASKS.values() else mask


def _text(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def _masked(c: Column, mask: str) -> tuple[Column, str]:
    """Weekday names cannot be parsed, so a leading one is cut from the text and the mask."""
    if mask.startswith(WEEKDAY):
        return F.regexp_replace(c, r"^[A-Za-z]{3} ", ""), mask[len(WEEKDAY):]
    return c, mask


_FIELD = re.compile(r"yyyy|MM|dd|HH|mm|ss|S{1,6}|'[^']*'|[^A-Za-z']")


def _fixed_fields(mask: str) -> tuple[str, dict[str, tuple[int, int]]] | None:
    """Shape and field places of a mask made of fixed-width numbers, else None."""
    tokens = _FIELD.findall(mask)
    if "".join(tokens) != mask:
        return None
    shape, places, at = "", {}, 1
    for token in tokens:
        if token[0].isalpha():
            if token[0] in places:
                return None
            places[token[0]] = (at, len(token))
            shape += f"[0-9]{{{len(token)}}}"
            at += len(token)
        else:
            literal = token.strip("'") or "'"
            shape += re.escape(literal)
            at += len(literal)
    return f"^{shape}$", places


def _iso(c: Column, places: dict[str, tuple[int, int]], fields: str, between: str, absent: str) -> list[Column]:
    parts = []
    for field, sep, default in zip(fields, between, absent.split()):
        here = F.substring(c, *places[field]) if field in places else F.lit(default)
        parts += [here] if sep == " " else [F.lit(sep), here]
    return parts


def _parse(c, mask: str, to: str) -> Column:
    """Text to a date or timestamp, null when it does not fit the mask.

    A mask of fixed-width numbers is checked by its shape and cast from its parts. The general
    parser raises and catches an exception for every text that does not fit, which costs more
    than the rest of a load when a column holds many of them.
    """
    c, mask = _masked(_col(c), mask)
    fixed = _fixed_fields(mask)
    if fixed is None:
        return F.try_to_timestamp(c, F.lit(mask)).cast(to)
    shape, places = fixed
    parts = _iso(c, places, "yMd", " --", "1970 01 01")
    if to != "date" or set("HmsS") & set(places):
        parts += [F.lit(" ")] + _iso(c, places, "Hms", " ::", "00 00 00")
        if "S" in places:
            parts += [F.lit("."), F.substring(c, *places["S"])]
    fits = F.when(c.rlike(shape), F.concat(*parts))
    if to == "date" and not set("HmsS") & set(places):
        return fits.try_cast("date")
    return fits.try_cast("timestamp").cast(to)


def parse_date(c, mask: str = ISO_DATE) -> Column:
    return _parse(c, mask, "date")


def parse_timestamp(c, mask: str = ISO_SECONDS) -> Column:
    return _parse(c, mask, "timestamp")


def empty_to_null_date(c) -> Column:
    return parse_date(_text(c))


def cast_as_date(c, mask: str) -> Column:
    return parse_date(_text(c), mask)


def date_or_sentinel(c, sentinel: str, alternative: str, mask: str) -> Column:
    """Date of the text; the sentinel text takes the date of ``alternative``."""
    c = _text(c)
    return parse_date(F.when(c == sentinel, F.lit(alternative)).otherwise(c), mask)


def date_or_sentinel_ne(c, sentinel: str, when_other: str, mask: str) -> Column:
    """The inverted test: the sentinel text parses itself, any other text takes ``when_other``."""
    c = _text(c)
    return parse_date(F.when(c != sentinel, F.lit(when_other)).otherwise(c), mask)


def nullif_to_timestamp(c, value: str, mask: str) -> Column:
    return parse_timestamp(F.nullif(_text(c), F.lit(value)), mask)


def nullif_to_date(c, value: str, mask: str) -> Column:
    return parse_date(F.nullif(_text(c), F.lit(value)), mask)


def now_if_empty(c, mask: str = ISO_MICROS) -> Column:
    """Query time for '' and null only; text that does not parse stays null."""
    c = _text(c)
    return F.when(c.isNull(), F.current_timestamp()).otherwise(parse_timestamp(c, mask))


def to_timestamp_fmt(c, mask: str) -> Column:
    return parse_timestamp(_text(c), mask)


def coalesce_timestamp(c, *defaults, mask: str = ISO_SECONDS) -> Column:
    """Timestamp of the text, else the first default (text or column) that is not null."""
    extra = [d if isinstance(d, Column) else parse_timestamp(F.lit(d), mask) for d in defaults]
    return F.coalesce(parse_timestamp(_text(c), mask), *extra)


def nullif_timestamp(a, b) -> Column:
    return F.nullif(_col(a), _col(b))


def us_timestamp(c) -> Column:
    """Month, day, year and clock at fixed positions, whatever the separators are."""
    c = _col(c)
    iso = F.concat(
        F.substring(c, 7, 4), F.lit("-"), F.substring(c, 1, 2), F.lit("-"),
        F.substring(c, 4, 2), F.substring(c, 11, 9),
    )
    return parse_timestamp(iso)


def prefixed_date(c, prefix: str, mask: str) -> Column:
    """Date of prefix + text, for years written without their century."""
    return parse_date(F.concat(F.lit(prefix), _text(c)), mask)


def iso_to_space_timestamp(c) -> Column:
    """``2024-01-01T01:02:03.4Z`` becomes the text ``2024-01-01 01:02:03``."""
    return F.replace(F.substring_index(_col(c), ".", 1), F.lit("T"), F.lit(" "))


def today() -> Column:
    return F.current_date()


def today_text(mask: str = ISO_DATE) -> Column:
    return F.date_format(F.current_date(), mask)


def time_text() -> Column:
    return F.date_format(F.current_timestamp(), "HH:mm:ss")


def load_timestamp(_ignored=None) -> Column:
    """Query time: one value for the whole load."""
    return F.current_timestamp()
