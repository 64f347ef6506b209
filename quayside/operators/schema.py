"""Bringing the columns of a table into their target shape.

Every function builds one projection, so a chain of them collapses into a single scan stage.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.numbers import read_as
from quayside.functions.temporal import (
    ISO_DATE,
    ISO_SECONDS,
    parse_date,
    parse_timestamp,
    translate_mask,
)
from quayside.operators.relational import join_back

# Type codes of catalogs and loaders, and the type names they stand for.
TYPE_NAMES = {
    -5: "BIGINT",
    -2: "BYTE",
    1: "STRING",
    3: "DECIMAL",
    4: "INT",
    7: "FLOAT",
    8: "DOUBLE",
    12: "STRING",
    16: "BOOLEAN",
    91: "DATE",
    93: "TIMESTAMP",
}
TYPE_NAME_OTHER = "Other"
TIME_CODE = 92

# What a null becomes when defaults are asked for, by type.
NULL_DEFAULTS = {
    "string": "",
    "int": "123",
    "bigint": "123",
    "decimal": "123.45",
    "float": "123.45",
    "double": "123.45",
    "date": "1990-01-01",
    "timestamp": "1990-01-01 00:00:00",
}
# What a column absent from the file is filled with, where it differs.
MISSING_DEFAULTS = {**NULL_DEFAULTS, "date": "9999-01-01", "timestamp": "9999-01-01 00:00:00"}
# Fallbacks of the two-argument nvl2 used in legacy specs.
FALLBACK_DEFAULTS = {
    "string": "",
    "int": "0",
    "bigint": "0",
    "decimal": "0",
    "float": "0",
    "double": "0",
    "date": "9999-01-01",
    "timestamp": "9999-01-01 00:00:00",
}
BATCH_ID_TOKEN = "||@load_batch_id||"
BATCH_ID_TYPE = "decimal(38,0)"
LOAD_DATE, LOAD_TIME, UPDATED_AT = "DW_LOAD_DT", "DW_LOAD_TM", "DW_UPDT_TS"
LOAD_USER, UPDATE_USER = "DW_LOAD_USER", "DW_UPDT_USER"

AUDIT_NAMES = ("file_name", "file_modified_at", "loaded_at", "is_deleted")


@dataclass(frozen=True)
class ColumnSpec:
    """One target column: where its text comes from and how it is typed."""

    name: str
    type: str = "string"
    source: str | None = None
    mask: str | None = None
    expression: str | None = None

    @property
    def source_name(self) -> str:
        return self.source or self.name


def resolve(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Exact column names for user-given ones, whatever their case; unknown names are an error."""
    known = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.strip().lower() not in known]
    if missing:
        raise ValueError(f"unknown columns {missing}; the table has {df.columns}")
    return [known[n.strip().lower()] for n in names]


def underscored(name: str) -> str:
    """Target table and schema names carry no spaces."""
    return name.replace(" ", "_")


def column_sizes(text: str) -> dict[str, int]:
    """``"C_NAME:30,C_PHONE:50"`` to sizes by upper-case name; unreadable entries are skipped."""
    entries = (e.split(":") for e in (text or "").split(","))
    return {
        e[0].strip().upper(): int(e[1])
        for e in entries
        if len(e) == 2 and e[0].strip() and e[1].strip().isdigit()
    }


def rename_map(df: DataFrame, mapping: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Project file columns to target names; one file column may feed several targets."""
    pairs = [
        (source, target)
        for source, targets in mapping.items()
        for target in ([targets] if isinstance(targets, str) else targets)
    ]
    return df.select([F.col(source).alias(target) for source, target in pairs])


def typed(c: Column, to: str, mask: str | None = None) -> Column:
    """Text to the wanted type, null when it does not fit. Masks may be legacy ones."""
    kind = to.lower()
    if kind == "string":
        return c
    if kind == "date":
        return parse_date(c, translate_mask(mask or ISO_DATE))
    if kind == "timestamp":
        return parse_timestamp(c, translate_mask(mask or ISO_SECONDS))
    return read_as(c, to)


def typed_projection(df: DataFrame, specs: Sequence[ColumnSpec], rejects: str | None = None) -> DataFrame:
    """Cast every column to its target type in one pass.

    With ``rejects``, an array column of that name lists the targets whose non-empty text did not
    parse, so nothing disappears silently.
    """
    columns, failed = [], []
    for spec in specs:
        if spec.expression:
            columns.append(F.expr(spec.expression).cast(spec.type).alias(spec.name))
            continue
        source = F.col(spec.source_name)
        value = typed(source, spec.type, spec.mask)
        columns.append(value.alias(spec.name))
        if spec.type.lower() != "string":
            bad = value.isNull() & source.isNotNull() & (F.trim(source) != "")
            failed.append(F.when(bad, F.lit(spec.name)))
    if rejects:
        listed = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
        columns.append(listed.alias(rejects))
    return df.select(columns)


def _constant(token, batch_id=None) -> Column:
    """A constant typed by its looks, or one of the clock names."""
    if not isinstance(token, str):
        return F.lit(token)
    plain = token.strip()
    clock = {
        "current_date": F.current_date(),
        "current_timestamp": F.current_timestamp(),
        "current_time": F.date_format(F.current_timestamp(), "HH:mm:ss"),
    }
    if plain.lower() in clock:
        return clock[plain.lower()]
    if plain.replace(" ", "").replace("'", "").lower() == BATCH_ID_TOKEN:
        return F.lit(batch_id).cast(BATCH_ID_TYPE)
    if re.fullmatch(r"[+-]?\d+", plain):
        return F.lit(int(plain)).cast("int")
    if re.fullmatch(r"[+-]?\d*\.\d+(e[+-]?\d+)?", plain, re.I):
        return F.lit(plain).cast("float")
    return F.lit(token)


def add_derived_columns(df: DataFrame, constants: Mapping[str, object], batch_id=None) -> DataFrame:
    """Add constants and clock columns: whole numbers are int, decimals float, the rest text."""
    return df.withColumns({name: _constant(token, batch_id) for name, token in constants.items()})


def _kind(dtype: T.DataType) -> str:
    return dtype.simpleString().split("(")[0]


def _default(dtype: T.DataType, defaults: Mapping[str, str]) -> Column:
    value = defaults.get(_kind(dtype).replace("timestamp_ntz", "timestamp"))
    return F.lit(value).cast(dtype)


def _concat_parts(text: str) -> Column:
    """``a||'x'||b``: quoted parts are literals, the others columns (a leading colon is dropped)."""
    parts = [p.strip() for p in text.strip().strip("()").split("||")]
    return F.concat(*[
        F.lit(p[1:-1]) if len(p) > 1 and p[0] == p[-1] == "'" else F.col(p.lstrip(":"))
        for p in parts
    ])


def add_missing_columns(
    df: DataFrame,
    target: T.StructType,
    mapped: Mapping[str, str] | None = None,
    use_defaults: bool = True,
) -> DataFrame:
    """Append the target columns the file lacks.

    A mapped column comes from another column or a concatenation; load date and time come from
    the clock, as do dates that have no mapping; the rest takes a default of its type, or null.
    """
    mapped = {k.lower(): v for k, v in (mapped or {}).items()}
    present = {c.lower() for c in df.columns}
    added = {}
    for field in target:
        name = field.name.lower()
        if name in present:
            continue
        if name in mapped:
            text = mapped[name]
            value = _concat_parts(text) if "||" in text else F.col(text.strip().lstrip(":"))
        elif name.upper() == LOAD_TIME:
            value = F.date_format(F.current_timestamp(), "HH:mm:ss")
        elif name.upper() == LOAD_DATE or isinstance(field.dataType, T.DateType):
            value = F.current_date()
        elif use_defaults:
            value = _default(field.dataType, MISSING_DEFAULTS)
        else:
            value = F.lit(None)
        added[field.name] = value if name.upper() == LOAD_TIME else value.cast(field.dataType)
    return df.withColumns(added) if added else df


def fill_null_defaults(df: DataFrame, defaults: Mapping[str, str] = NULL_DEFAULTS) -> DataFrame:
    """Replace nulls by the default of each column's type, dates and timestamps included."""
    known = {f.name for f in df.schema if _kind(f.dataType).replace("timestamp_ntz", "timestamp") in defaults}
    return df.select([
        F.coalesce(F.col(f.name), _default(f.dataType, defaults)).alias(f.name)
        if f.name in known else F.col(f.name)
        for f in df.schema
    ])


def keep_target_columns(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """Drop the file columns the target does not have."""
    wanted = {n.lower() for n in target}
    return df.select([c for c in df.columns if c.lower() in wanted])


def add_audit(df: DataFrame, prefix: str = "audit_") -> DataFrame:
    """File name, file modification time, load time and a deleted flag. ``df`` is a file scan."""
    file_name, modified, loaded, deleted = (prefix + n for n in AUDIT_NAMES)
    return df.select(
        "*",
        F.col("_metadata.file_name").alias(file_name),
        F.col("_metadata.file_modification_time").alias(modified),
        F.current_timestamp().alias(loaded),
        F.lit(False).alias(deleted),
    )


def drop_audit(df: DataFrame, prefix: str = "audit_", flagged: Iterable[str] = ()) -> DataFrame:
    """Leave out columns that carry the audit prefix or are flagged as audit columns."""
    flagged = {f.lower() for f in flagged}
    return df.select([
        c for c in df.columns
        if not c.lower().startswith(prefix.lower()) and c.lower() not in flagged
    ])


def rtrim_strings(df: DataFrame, transformed: Iterable[str] = ()) -> DataFrame:
    """Right-trim string columns, null to ''. Columns that have a transform already are left."""
    skip = {t.lower() for t in transformed}
    return df.select([
        F.coalesce(F.rtrim(F.col(f.name)), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) and f.name.lower() not in skip
        else F.col(f.name)
        for f in df.schema
    ])


def uppercase_columns(df: DataFrame, only: Iterable[str] | None = None) -> DataFrame:
    """Upper-case all column names, or exactly the listed ones."""
    listed = None if only is None else set(only)
    return df.toDF(*[c.upper() if listed is None or c in listed else c for c in df.columns])


def column_expressions(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Replace or add columns by Spark SQL expressions."""
    return df.withColumns({name: F.expr(text) for name, text in expressions.items()})


def json_struct_column(df: DataFrame, name: str, ddl: str, into: str | None = None) -> DataFrame:
    """Parse a JSON text column into a struct given as DDL."""
    return df.withColumn(into or name, F.from_json(F.col(name), ddl))


def widen_floats(df: DataFrame) -> DataFrame:
    """FLOAT to DOUBLE by way of text, so 1.1 stays 1.1 and does not become 1.10000002384."""
    return df.select([
        F.col(f.name).cast("string").cast("double").alias(f.name)
        if isinstance(f.dataType, T.FloatType) else F.col(f.name)
        for f in df.schema
    ])


def type_name(code) -> Column:
    """Type name of a type code column."""
    code = F.col(code) if isinstance(code, str) else code
    pairs = [F.lit(x) for pair in TYPE_NAMES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit(TYPE_NAME_OTHER))


def columns_json(name, type_code, position, where=None) -> Column:
    """Aggregate: JSON text of column name to type name, in column order.

    Its size is the number of columns of one table, which the catalog bounds.
    """
    entry = F.struct(
        F.col(position).alias("position"),
        F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('\\"')), F.lit('": "'),
                 type_name(type_code), F.lit('"')).alias("text"),
    )
    kept = entry if where is None else F.when(where, entry)
    entries = F.array_sort(F.collect_list(kept))
    return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: e["text"]), ", "), F.lit("}"))


def nested_path(json_text, path: str) -> Column:
    """Value at a dotted path with integer indexes; '' when there is none."""
    steps = "".join(f"[{p}]" if p.isdigit() else f".{p}" for p in path.split("."))
    json_text = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.coalesce(F.get_json_object(json_text, "$" + steps), F.lit(""))


def exclude_listed(configs: DataFrame, listed: DataFrame, name: str, group: str, quota: str = "quota") -> DataFrame:
    """Take listed tables out and share a quota of 100 among those left in each group.

    The share is counted by an aggregate and joined back, so a large group is never sorted or
    held in one task.
    """
    left = configs.join(listed.select(name).distinct(), name, "left_anti")
    share = left.groupBy(group).agg(F.floor(F.lit(100) / F.count("*")).cast("int").alias(quota))
    kept = left.drop(quota)
    return join_back(kept, share, [group], [quota]).select(*kept.columns, quota)


def epoch_to(c, target: str) -> Column:
    """Seconds since 1970 to a date, a timestamp or a clock text (``time``)."""
    c = F.col(c) if isinstance(c, str) else c
    instant = F.timestamp_seconds(c)
    if target == "time":
        return F.date_format(instant, "HH:mm:ss")
    return instant.cast(target)


def sync_to_target(
    df: DataFrame,
    target: T.StructType,
    user: str = "",
    epoch_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Shape ``df`` like the target table: its columns, plus target-only ones, in target order.

    Source columns the target lacks are left out. Numeric sources named in ``epoch_types`` are
    read as seconds since 1970. Target-only columns get load date, time, timestamp or user by
    their name, otherwise null.
    """
    have = {f.name.lower(): f for f in df.schema}
    by_name = {
        LOAD_DATE: F.current_date(),
        LOAD_TIME: F.date_format(F.current_timestamp(), "HH:mm:ss"),
        UPDATED_AT: F.current_timestamp(),
        LOAD_USER: F.lit(user.upper()),
        UPDATE_USER: F.lit(user.upper()),
    }
    epochs = {k.lower(): v for k, v in (epoch_types or {}).items()}
    columns = []
    for field in target:
        name = field.name.lower()
        if name in have and name in epochs:
            value = epoch_to(have[name].name, epochs[name])
        elif name in have:
            value = F.col(have[name].name)
        else:
            value = by_name.get(field.name.upper(), F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)
