"""Row filters built from text rules, as native predicates that reach the scan."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.schema import resolve

# A joiner, or a quoted text, which may hold what looks like one.
_JOINERS = re.compile(r"'(?:[^']|'')*'|\[(?P<joiner>and|or)\]", re.I)
# The operators a condition may use. A word operator needs blanks around it, so a
# column such as l_linenumber is not cut at "in".
_CONDITION = re.compile(
    r"^\s*(?P<column>`[^`]+`|[\w.]+)\s*"
    r"(?P<op><=>|<>|<=|>=|=|<|>"
    r"|(?<=\s)(?:is\s+not\s+null|is\s+null|not\s+like|not\s+in|like|rlike|in)\b)"
    r"\s*(?P<value>.*?)\s*$",
    re.I | re.S,
)


def subset_filter(df: DataFrame, rule: str) -> DataFrame:
    """Keep the rows a rule names: conditions joined by ``[and]`` / ``[or]``.

    Column names match in any case and must exist. ``[and]`` binds tighter than ``[or]``.
    A bare word on the right-hand side is a text.
    """
    if not rule or not rule.strip():
        return df
    text, start = "", 0
    for joiner in (m for m in _JOINERS.finditer(rule) if m["joiner"]):
        text += f"{_condition(df, rule[start:joiner.start()])} {joiner['joiner'].upper()} "
        start = joiner.end()
    return df.where(F.expr(text + _condition(df, rule[start:])))


def _condition(df: DataFrame, text: str) -> str:
    found = _CONDITION.match(text)
    if not found:
        raise ValueError(f"not a condition: {text.strip()!r}")
    name = resolve(df, [found["column"].strip("`")])[0]
    op = " ".join(found["op"].upper().split())
    value = found["value"]
    if op.startswith("IS"):
        if value:
            raise ValueError(f"{op} takes no value: {text.strip()!r}")
        return f"`{name}` {op}"
    if not value:
        raise ValueError(f"{op} needs a value: {text.strip()!r}")
    if op.endswith("IN"):
        items = _list_items(value)
        return f"`{name}` {op} ({', '.join(items)})"
    return f"`{name}` {op} {_operand(value)}"


def _list_items(value: str) -> list[str]:
    inner = value[1:-1] if value.startswith("(") and value.endswith(")") else value
    return [_operand(v) for v in re.findall(r"'(?:[^']|'')*'|[^,]+", inner) if v.strip()]


def _operand(value: str) -> str:
    """Numbers, quoted texts and typed literals stay; anything else is quoted."""
    value = value.strip()
    if re.fullmatch(r"[+-]?\d+(\.\d+)?|'(?:[^']|'')*'|(date|timestamp)\s*'[^']*'|null|true|false", value, re.I):
        return value
    quoted = value.strip('"').replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """The rows that stay when those matching ``condition`` are deleted; unknown is not a match."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def selective_insert(df: DataFrame, condition: str | None) -> DataFrame:
    """Only the rows a loader's WHERE lets through."""
    return df.where(F.expr(condition)) if condition and condition.strip() else df


def combine_conditions(rules: DataFrame, table: str, deletes: str, inserts: str) -> DataFrame:
    """One OR-joined delete and insert condition per table, each text once, in sorted order.

    Both lists are made distinct by partial aggregation before the shuffle; their length is the
    number of different clauses written for one table.
    """
    def joined(name):
        return F.nullif(F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(name), F.lit("")))), " OR "), F.lit(""))

    return rules.groupBy(table).agg(joined(deletes).alias(deletes), joined(inserts).alias(inserts))


def high_water_filter(df: DataFrame, marks: Sequence[str], last) -> DataFrame:
    """Rows whose newest mark column lies after the last value pulled.

    With one column the comparison reaches the scan. With several, the newest of them is past
    ``last`` exactly when one of them is.
    """
    bound = F.lit(last)
    return df.where(reduce(Column.__or__, [F.col(m) > bound for m in marks]))


def next_high_water(df: DataFrame, marks: Sequence[str]) -> DataFrame:
    """One row holding the value to store for the next pull."""
    newest = F.greatest(*[F.col(m) for m in marks]) if len(marks) > 1 else F.col(marks[0])
    return df.agg(F.max(newest).alias("high_water_mark"))


def name_filter(df: DataFrame, name: str, patterns: Iterable[str] = (), tags: str | None = None, tag=None) -> DataFrame:
    """Rows whose name matches any pattern or that carry a tag."""
    tests = [F.col(name).rlike(p) for p in patterns]
    if tags and tag is not None:
        tests.append(F.coalesce(F.array_contains(F.col(tags), tag), F.lit(False)))
    return df.where(reduce(Column.__or__, tests)) if tests else df
