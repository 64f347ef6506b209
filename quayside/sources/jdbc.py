"""Tables and catalogs read over JDBC, and the split expressions that make the read parallel."""

from __future__ import annotations

import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Date parts a split column may be derived by, with the number of their values.
DATE_SPLITS = {"dd": 31, "MM": 12, "yyyy": None, "yyyyMM": None, "MMdd": 366, "yyyyMMdd": None}
HASH_SPLITS = ("mod", "hashamp_hashbucket_hashrow")
DEFAULT_DATE_SPLIT = "MM"
# Reads of equal size from a sketch of the column, and quantiles that are put together for one.
DEPTH_SPLIT, CELLS = "depth", 4

# Schemas and tables that belong to the database itself.
SYSTEM_OWNERS = {"netezza": ("ADMIN",)}
SYSTEM_SCHEMAS = {
    "teradata": (
        "All", "Crashdumps", "DBC", "dbcmngr", "Default", "External_AP", "EXTUSER", "LockLogShredder",
        "PUBLIC", "Sys_Calendar", "SysAdmin", "SYSBAR", "SYSJDBC", "SYSLIB", "SystemFe", "SYSUDTLIB",
        "SYSUIF", "TD_SERVER_DB", "TDStats", "TD_SYSGPL", "TD_SYSXML", "TDMaps", "TDPUSER", "TDQCD",
        "tdwm", "SQLJ", "TD_SYSFNLIB", "SYSSPATIAL",
    ),
    "oracle": (
        "ANONYMOUS", "CTXSYS", "DBSNMP", "EXFSYS", "LBACSYS", "MDSYS", "MGMT_VIEW", "OLAPSYS", "OWBSYS",
        "ORDPLUGINS", "ORDSYS", "OUTLN", "SI_INFORMTN_SCHEMA", "SYS", "SYSMAN", "SYSTEM", "TSMSYS",
        "WK_TEST", "WKPROXY", "WMSYS", "XDB", "APEX_040000", "APEX_040200", "APEX_PUBLIC_USER", "DIP",
        "FLOWS_30000", "FLOWS_FILES", "MDDATA", "ORACLE_OCM", "XS$NULL", "SPATIAL_CSW_ADMIN_USR",
        "SPATIAL_WFS_ADMIN_USR", "WKSYS", "PUBLIC",
    ),
    "snowflake": ("INFORMATION_SCHEMA",),
}
RECYCLED_TABLES = "BIN$%"

# Column types that make a good split column, as patterns over the type name.
SPLIT_TYPES = {
    "teradata": "DA|AT|TS|TZ|SZ|YR|YM|MO|DY|DH|DM|DS|HR|HM|HS|MI|MS|SC",
    "oracle": "DATE|TIMESTAMP.*",
    "vertica": "interval.*|date.*|time.*",
    "mysql": "date|timestamp|int",
    "netezza": "TIMESTAMP|DATE",
    "snowflake": "DATE|NUMBER|FLOAT|TIMESTAMP.*",
    "sqlserver": "int|bigint|datetime|datetime2|decimal|float|numeric",
}

# Where each database lists its tables, key columns and columns. Only plain rows are asked of the
# database; lists and joins are made here.
CATALOG_VIEWS = {
    "teradata": {
        "tables": "SELECT DataBaseName AS schema_name, TableName AS table_name, TableKind AS kind FROM DBC.TablesV WHERE TableKind IN ('T', 'V')",
        "keys": "SELECT DatabaseName AS schema_name, TableName AS table_name, ColumnName AS column_name, ColumnPosition AS position FROM DBC.IndicesV WHERE IndexType IN ('K', 'P', 'A', 'U', 'Q') OR IndexNumber = 1",
        "columns": "SELECT DatabaseName AS schema_name, TableName AS table_name, ColumnName AS column_name, ColumnType AS type_name, ColumnId AS position FROM DBC.ColumnsV",
    },
    "oracle": {
        "tables": "SELECT owner AS schema_name, table_name, 'T' AS kind FROM sys.all_tables UNION ALL SELECT owner, view_name, 'V' FROM sys.all_views",
        "keys": "SELECT c.owner AS schema_name, c.table_name, c.column_name, c.position FROM sys.all_cons_columns c JOIN sys.all_constraints k ON k.owner = c.owner AND k.constraint_name = c.constraint_name WHERE k.constraint_type IN ('P', 'U')",
        "columns": "SELECT owner AS schema_name, table_name, column_name, data_type AS type_name, column_id AS position FROM sys.all_tab_cols",
    },
    "vertica": {
        "tables": "SELECT table_schema AS schema_name, table_name, 'T' AS kind FROM v_catalog.tables UNION ALL SELECT table_schema, table_name, 'V' FROM v_catalog.views",
        "keys": "SELECT table_schema AS schema_name, table_name, column_name, 0 AS position FROM v_catalog.constraint_columns WHERE constraint_type IN ('p', 'u')",
        "columns": "SELECT table_schema AS schema_name, table_name, column_name, data_type AS type_name, ordinal_position AS position FROM v_catalog.columns",
    },
    "mysql": {
        "tables": "SELECT table_schema AS schema_name, table_name, table_type AS kind FROM information_schema.tables",
        "keys": "SELECT table_schema AS schema_name, table_name, column_name, seq_in_index AS position FROM information_schema.statistics WHERE index_name = 'primary'",
        "columns": "SELECT table_schema AS schema_name, table_name, column_name, data_type AS type_name, ordinal_position AS position FROM information_schema.columns",
    },
    "netezza": {
        "tables": "SELECT schema AS schema_name, tablename AS table_name, 'T' AS kind FROM _v_table",
        "keys": "SELECT schema AS schema_name, relation AS table_name, attname AS column_name, conseq AS position FROM _v_relation_keydata WHERE contype IN ('p', 'u')",
        "columns": "SELECT schema AS schema_name, table_name, column_name, type_name, ordinal_position AS position FROM _v_sys_columns",
    },
    "snowflake": {
        "tables": "SELECT table_schema AS schema_name, table_name, table_type AS kind FROM information_schema.tables",
        "keys": "SELECT k.table_schema AS schema_name, k.table_name, k.column_name, k.ordinal_position AS position FROM information_schema.key_column_usage k",
        "columns": "SELECT table_schema AS schema_name, table_name, column_name, data_type AS type_name, ordinal_position AS position FROM information_schema.columns",
    },
    "sqlserver": {
        "tables": "SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name, TABLE_TYPE AS kind FROM INFORMATION_SCHEMA.TABLES",
        "keys": "SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name, ORDINAL_POSITION AS position FROM INFORMATION_SCHEMA.KEY_COLUMN_USAGE",
        "columns": "SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name, DATA_TYPE AS type_name, ORDINAL_POSITION AS position FROM INFORMATION_SCHEMA.COLUMNS",
    },
}


@dataclass(frozen=True)
class Split:
    """How a table is cut for a parallel read."""

    column: str
    how: str | None = None
    buckets: int = 8
    spread: str | None = None


def default_split(column: str, type_name: str, dialect: str | None = None) -> Split:
    """Dates and timestamps are split by month (not in Vertica); other columns by their value."""
    is_date = type_name.lower().startswith(("date", "timestamp"))
    return Split(column, DEFAULT_DATE_SPLIT if is_date and dialect != "vertica" else None)


def split_bucket(column, how: str, buckets: int = 8) -> Column:
    """The derived split value of a row."""
    c = F.col(column) if isinstance(column, str) else column
    if how in DATE_SPLITS:
        return F.date_format(c, how).cast("int")
    if how == "mod":
        return F.pmod(c, F.lit(buckets)).cast("int")
    if how in HASH_SPLITS:
        return F.pmod(F.hash(c), F.lit(buckets)).cast("int")
    raise ValueError(f"split {how!r} is not one of {', '.join([*DATE_SPLITS, *HASH_SPLITS])}")


def split_expression(split: Split, dialect: str | None = None) -> str:
    """The derived split value as a database computes it; SQL Server has its own names for it."""
    c = split.column
    own = dialect == "sqlserver"
    day, month, year = (f"DATEPART({p}, {c})" if own else f"EXTRACT({p} FROM {c})" for p in ("DAY", "MONTH", "YEAR"))
    amp = f"HASHAMP(HASHBUCKET(HASHROW({c})))"
    return {
        "dd": day,
        "MM": month,
        "yyyy": year,
        "yyyyMM": f"({year} * 100 + {month})",
        "MMdd": f"({month} * 100 + {day})",
        "yyyyMMdd": f"({year} * 10000 + {month} * 100 + {day})",
        "mod": f"({c} % {split.buckets})" if own else f"MOD({c}, {split.buckets})",
        "hashamp_hashbucket_hashrow": f"MOD({amp}, {split.buckets})",
    }[split.how]


def split_predicates(split: Split, values: Sequence | None = None, dialect: str | None = None) -> list[str]:
    """One WHERE text per read task. Together they cover every row once, nulls included.

    ``values`` are the split values of an open-ended date part such as ``yyyyMM``.
    """
    derived = split_expression(split, dialect)
    if values is None:
        if split.how == "mod":
            values = range(-split.buckets + 1, split.buckets)
        elif split.how in HASH_SPLITS:
            values = range(split.buckets)
        elif split.how == "MMdd":
            values = [m * 100 + d for m in range(1, 13) for d in range(1, 32)]
        elif DATE_SPLITS.get(split.how):
            values = range(1, DATE_SPLITS[split.how] + 1)
        else:
            raise ValueError(f"split {split.how!r} needs its values")
    groups: list[list] = [[] for _ in range(min(split.buckets, len(values)))]
    for i, value in enumerate(values):
        groups[i % len(groups)].append(value)
    listed = ", ".join(str(v) for v in values)
    first = f"{derived} IN ({', '.join(map(str, groups[0]))}) OR {split.column} IS NULL OR {derived} NOT IN ({listed})"
    return [f"({first})"] + [f"({derived} IN ({', '.join(map(str, g))}))" for g in groups[1:]]


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float, decimal.Decimal)) else f"'{value}'"


def depth_predicates(
    values: DataFrame, column: str, tasks: int, spread: str | None = None, dialect: str | None = None, accuracy: int = 100_000
) -> list[str]:
    """WHERE texts of about ``tasks`` reads of about equal size, however skewed ``column`` is.

    The bounds come from a quantile sketch of ``values``, which tasks make of their own rows and Spark
    merges: four quantiles a read, which are put together until they are a read's share. A value that
    holds three quantiles or more is a read of its own; if it is more than one share, it is cut further
    by the remainder of ``spread``, a numeric column. Without one it stays whole. Together the texts
    cover every row once, nulls included, also rows that were not there when the sketch was made.
    """
    cells = CELLS * tasks
    points = [F.lit(k / cells) for k in range(1, cells)]
    found = values.agg(F.percentile_approx(column, F.array(*points), F.lit(accuracy)).alias("q")).head()["q"]  # a few per task
    if not found:
        return ["(1 = 1)"]
    at_value = {v: found.count(v) for v in found}
    texts, low, before, share = [], None, None, 0

    def span(low, high, closed: bool) -> str:
        parts = [] if low is None else [f"{column} > {_literal(low)}"]
        parts += [] if high is None else [f"{column} {'<=' if closed else '<'} {_literal(high)}"]
        return " AND ".join(parts) or "1 = 1"

    for value in sorted(at_value):
        hot = at_value[value] > CELLS // 2
        if hot:
            texts.append(f"({span(low, value, False)})")
            pieces = -(-(at_value[value] + 1) // CELLS) if spread else 1
            for k in range(pieces):
                rest = f"ABS({spread}) % {pieces}" if dialect == "sqlserver" else f"MOD(ABS({spread}), {pieces})"
                cut = "" if pieces == 1 else f" AND {rest} = {k}" if k else f" AND ({spread} IS NULL OR {rest} = 0)"
                texts.append(f"({column} = {_literal(value)}{cut})")
            low, share = value, 0
            continue
        if share and share + at_value[value] > CELLS:
            texts.append(f"({span(low, before, True)})")
            low, share = before, 0
        share += at_value[value]
        before = value
        if share >= CELLS:
            texts.append(f"({span(low, value, True)})")
            low, share = value, 0
    return [*texts, f"({span(low, None, True)} OR {column} IS NULL)"]


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    split: Split | None = None,
    bounds: tuple | None = None,
    values: Sequence | DataFrame | None = None,
    properties: Mapping[str, str] | None = None,
    dialect: str | None = None,
) -> DataFrame:
    """Read a table with one connection per split instead of one for all rows.

    A plain numeric or date column uses ``bounds``; a derived split uses one predicate per task. The
    values of an open-ended date part are asked of the database if they are not given. A split by
    ``depth`` first reads the split column alone and sketches it, unless ``values`` is a frame of it.
    Filters and column selections made on the result are pushed into the database.
    """
    properties = dict(properties or {})
    if split is None:
        return spark.read.jdbc(url, table, properties=properties)
    if split.how == DEPTH_SPLIT:
        column = values if values is not None else spark.read.jdbc(url, f"(SELECT {split.column} FROM {table}) q", properties=properties)
        texts = depth_predicates(column, split.column, split.buckets, split.spread, dialect)
        return spark.read.jdbc(url, table, predicates=texts, properties=properties)
    if split.how:
        if values is None and split.how not in HASH_SPLITS and not DATE_SPLITS.get(split.how):
            asked = f"(SELECT DISTINCT {split_expression(split, dialect)} AS v FROM {table}) q"
            found = spark.read.jdbc(url, asked, properties=properties).toLocalIterator()  # one row per date part
            values = sorted(r[0] for r in found if r[0] is not None)
        return spark.read.jdbc(url, table, predicates=split_predicates(split, values, dialect), properties=properties)
    if bounds is None:
        raise ValueError("a split by value needs the lowest and highest value")
    return spark.read.jdbc(
        url, table, column=split.column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=split.buckets, properties=properties,
    )


def catalog_rows(spark: SparkSession, url: str, dialect: str, what: str, properties=None) -> DataFrame:
    """Plain catalog rows of a database: its ``tables``, ``keys`` or ``columns``."""
    query = CATALOG_VIEWS[dialect][what]
    return spark.read.jdbc(url, f"({query}) q", properties=dict(properties or {}))


def union_tables_views(tables: DataFrame, views: DataFrame) -> DataFrame:
    return tables.unionByName(views).distinct()


def drop_system_tables(
    df: DataFrame, dialect: str, schema: str = "schema_name", table: str = "table_name", owner: str | None = None
) -> DataFrame:
    """Leave out the database's own schemas and recycled tables, and those of its own users where
    ``owner`` names the column that tells whose a table is."""
    kept = ~F.col(table).like(RECYCLED_TABLES)
    if owner and dialect in SYSTEM_OWNERS:
        kept = kept & ~F.coalesce(F.col(owner).isin(*SYSTEM_OWNERS[dialect]), F.lit(False))
    names = SYSTEM_SCHEMAS.get(dialect, ())
    return df.where(kept & ~F.col(schema).isin(*names) if names else kept)


def catalog_profile(tables: DataFrame, keys: DataFrame, columns: DataFrame, dialect: str) -> DataFrame:
    """Per table: its key columns in key order and its split candidates, as comma lists.

    The lists are as long as the table has columns, which the database bounds.
    """
    def listed(df, out):
        ordered = F.array_sort(F.collect_list(F.struct("position", "column_name")))
        return df.groupBy("schema_name", "table_name").agg(
            F.array_join(F.transform(ordered, lambda e: e["column_name"]), ",").alias(out))

    candidates = columns.where(F.col("type_name").rlike(f"^({SPLIT_TYPES[dialect]})$"))
    on = ["schema_name", "table_name"]
    return (
        tables.join(listed(keys, "natural_keys"), on, "left")
        .join(listed(candidates, "split_candidates"), on, "left")
    )
