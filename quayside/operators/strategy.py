"""Choosing how each table is loaded: logic over control tables, one row per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.relational import join_back

# Load strategies, and the columns that mark new or changed rows.
MERGE, APPEND, FULL = "INCREMENTAL_MERGE", "INCREMENTAL_APPEND", "FULL_REFRESH"
APPEND_MARKS = ["insert_timestamp", "LOADDATE", "REC ADD TS", "STARTDATE", "CREATE_DATE"]
MERGE_MARKS = [
    "UPDATEDATE", "UPDATE_DATE", "CREATE_DATE", "update_timestamp", "REC_UPD_TS", "REC CHG TS",
    "it_update_date", "OrderDate",
]
# What a control row holds when nobody said otherwise.
CONTROL_DEFAULTS = {
    "DERIVE_SPLIT_COLUMN_FUCTION": "",
    "STORAGE_FORMAT": "parquet",
    "INGESTION_STRATEGY": "",
    "WATERMARK_COLUMN": "",
    "TPT_READER_INSTANCES": "",
    "TPT_WRITER_INSTANCES": "",
    "TPT_OR_JDBC": "",
    "TABLE_GROUP_NAME": "",
    "CONNECTION_QUOTA": "",
    "PARTITION_COLUMN": "",
    "DERIVED_PARTITION": "False",
    "DERIVED_FORMAT": "",
    "SCD_TYPE_2": "False",
    "TPT_WITHOUT_PROCESSING": "False",
    "TABLE_TYPE": "managed_table",
    "USER_MANAGED_TABLE_TARGET_PATH": "",
    "RTRIM_STRING_COLUMNS": "False",
    "CUSTOM_TAGS": "",
}
KEY_SUFFIX = "(id|key)$"


def comma_list(c) -> Column:
    """Trimmed, non-empty entries of a comma list."""
    c = F.col(c) if isinstance(c, str) else c
    entries = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda e: F.trim(e))
    return F.filter(entries, lambda e: e != "")


def _marks_in(candidates: Column, marks: Sequence[str]) -> Column:
    """The configured marks among the candidates, in configured order."""
    return F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: F.array_contains(candidates, m))


def choose_strategy(
    control: DataFrame,
    keys: str = "natural_keys",
    candidates: str = "split_candidates",
    merge_marks: Sequence[str] = MERGE_MARKS,
    append_marks: Sequence[str] = APPEND_MARKS,
    first_only: bool = False,
) -> DataFrame:
    """Add ``strategy`` and ``watermark`` to each control row.

    A key and a merge mark give a merge, a key and an append mark an append, anything else a full
    refresh. The watermark is every matching mark, or only the first in configured order.
    """
    listed = comma_list(candidates)
    has_key = F.size(comma_list(keys)) > 0
    merge, append = _marks_in(listed, merge_marks), _marks_in(listed, append_marks)

    def text(found):
        return F.coalesce(F.get(found, F.lit(0)), F.lit("")) if first_only else F.array_join(found, ",")

    to_merge = has_key & (F.size(merge) > 0)
    to_append = has_key & (F.size(append) > 0)
    return control.withColumns({
        "strategy": F.when(to_merge, MERGE).when(to_append, APPEND).otherwise(FULL),
        "watermark": F.when(to_merge, text(merge)).when(to_append, text(append)).otherwise(""),
    })


def probable_keys(columns, explicit=None, included=None, pattern: str | None = None) -> Column:
    """Explicit keys if there are any, else the included columns that look like keys."""
    columns = F.col(columns) if isinstance(columns, str) else columns
    looks = columns if included is None else F.array_intersect(columns, included)
    found = F.filter(
        looks, lambda c: F.lower(c).rlike(KEY_SUFFIX) | (c.rlike(f"^(?:{pattern})") if pattern else F.lit(False)))
    if explicit is None:
        return found
    given = comma_list(explicit)
    return F.when(F.size(given) > 0, given).otherwise(found)


def with_control_defaults(
    tables: DataFrame, schema: str, table: str, overrides: Mapping[str, object] | None = None
) -> DataFrame:
    """Add the control columns that are missing, with their defaults and target names."""
    have = {c.upper() for c in tables.columns}
    values = {k: F.lit(v) for k, v in {**CONTROL_DEFAULTS, **(overrides or {})}.items()}
    values.setdefault("TARGET_SCHEMA_NAME", F.replace(F.col(schema), F.lit(" "), F.lit("_")))
    values.setdefault("TARGET_TABLE_NAME", F.replace(F.col(table), F.lit(" "), F.lit("_")))
    return tables.withColumns({k: v for k, v in values.items() if k.upper() not in have})


def with_user_overrides(derived: DataFrame, user: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """User values win where they are given and not empty."""
    given = user.select(key, *[F.col(c).alias(f"_user_{c}") for c in columns])
    joined = derived.join(given, key, "left")
    chosen = {c: F.coalesce(F.nullif(F.trim(F.col(f"_user_{c}")), F.lit("")), F.col(c)) for c in columns}
    return joined.withColumns(chosen).select(*derived.columns)


def keys_from_update(where) -> Column:
    """Left-hand sides of the conditions of an UPDATE's WHERE: ``a = :a AND b = :b``."""
    where = F.col(where) if isinstance(where, str) else where
    terms = F.split(where, r"(?i)\s+AND\s+")
    return F.transform(terms, lambda x: F.trim(F.get(F.split(x, r"(?i)=|\s+IS\s+"), F.lit(0))))


def last_spec_per_table(specs: DataFrame, table: str, sequence: str) -> DataFrame:
    """The last row written for a table wins: one aggregate with map-side combining, no sort."""
    rest = [c for c in specs.columns if c != table]
    last = F.max_by(F.struct(*rest), F.col(sequence)).alias("last")
    return specs.groupBy(table).agg(last).select(table, "last.*").select(*specs.columns)


def join_details(loaders: DataFrame, details: DataFrame, left: str, right: str) -> DataFrame:
    """Loader rows with the details of their table; names match in any case."""
    return loaders.join(details, F.upper(F.col(left)) == F.upper(F.col(right)), "inner")


def publish_specs(
    tables: DataFrame, prefix: str, include: DataFrame | None = None, exclude: DataFrame | None = None
) -> DataFrame:
    """One publishing spec per table. Include and exclude lists are DataFrames of ``table_id``."""
    if include is not None:
        tables = tables.join(include.select("table_id"), "table_id", "left_semi")
    if exclude is not None:
        tables = tables.join(exclude.select("table_id"), "table_id", "left_anti")
    return tables.select(
        "table_id",
        F.concat(F.lit(prefix), "target_table").alias("spec_name"),
        "target_schema",
        "target_table",
        F.array_join("natural_keys", ",").alias("natural_keys"),
        "sync_type",
        F.upper("strategy").alias("update_strategy"),
        F.array_join("watermarks", ",").alias("watermark_columns"),
    )


def build_mode(sync_type="sync_type", strategy="update_strategy") -> Column:
    """Full loads overwrite; the rest follow their update strategy."""
    return F.when(F.lower(sync_type) == "full-load", "overwrite").otherwise(F.lower(strategy))


def group_quota(members: DataFrame, group: str, table: str, override: str) -> DataFrame:
    """Tables of each group once, with their connection quota: the override, else 100 shared out."""
    tables = members.groupBy(group, table).agg(F.max(override).alias("_override"))
    sizes = tables.groupBy(group).agg(F.count("*").alias("n_tables"))
    share = F.floor(F.lit(100) / F.col("n_tables"))
    return join_back(tables, sizes, [group], ["n_tables"]).select(
        group, table, "n_tables",
        F.coalesce(F.nullif(F.col("_override"), F.lit(0)), share).cast("int").alias("quota"))
