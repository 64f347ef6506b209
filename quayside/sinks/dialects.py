"""What each database calls its types, and the statements around a bulk load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# SQL type by Spark type, per database.
_MYSQL = {
    "decimal": "DECIMAL", "int": "INT", "float": "FLOAT", "double": "DOUBLE", "bigint": "BIGINT",
    "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP", "array": "TEXT",
    "binary": "BLOB", "boolean": "BOOLEAN", "tinyint": "TINYINT", "interval": "INTERVAL", "void": "null",
}
_VERTICA = {
    "decimal": "DECIMAL", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE PRECISION", "bigint": "BIGINT",
    "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE", "timestamp": "TIMESTAMP", "array": "ARRAY",
    "binary": "VARBINARY", "boolean": "BOOLEAN", "tinyint": "TINYINT", "interval": "INTERVAL", "void": "null",
}
_SPANNER = {
    "decimal": "NUMERIC", "int": "INT64", "float": "FLOAT64", "double": "FLOAT64", "bigint": "INT64",
    "smallint": "INT64", "tinyint": "BYTES(1)", "string": "STRING(MAX)", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOL", "binary": "BYTES(MAX)",
}

@dataclass(frozen=True)
class Dialect:
    """Types and quoting of one database."""

    name: str
    types: Mapping[str, str]
    quote: str = ""
    long_text: str = "LONG VARCHAR"
    all_text: str = "LONG VARCHAR"
    plain_text: str | None = None
    precise: bool = True

    def quoted(self, name: str) -> str:
        return f"{self.quote}{name}{self.quote}"


MYSQL = Dialect("mysql", _MYSQL, long_text="LONG VARCHAR", all_text="TEXT", plain_text="LONGTEXT")
VERTICA = Dialect("vertica", _VERTICA)
SPANNER = Dialect("spanner", _SPANNER, quote="`", precise=False)
DIALECTS = {d.name: d for d in (MYSQL, VERTICA, SPANNER)}

# JDBC type codes whose Spark type a database wants otherwise than Spark reads it.
JDBC_NUMERIC, JDBC_REAL, JDBC_SMALLINT, JDBC_BIT, JDBC_OTHER = 2, 7, 5, -7, 1111


def read_type(dialect: Dialect, code: int, type_name: str = "", size: int = 1) -> T.DataType | None:
    """Spark type of a column read back, where it differs from the default; for ``customSchema``."""
    if dialect is SPANNER:
        return T.DecimalType(38, 9) if code == JDBC_NUMERIC else None
    if dialect is VERTICA:
        if code == JDBC_BIT and type_name == "bit" and size != 1:
            return T.BinaryType()
        return {JDBC_REAL: T.FloatType(), JDBC_SMALLINT: T.ShortType(), JDBC_OTHER: T.StringType()}.get(code)
    return None


@dataclass(frozen=True)
class TextSizes:
    """Sizes of string columns by upper-case name, see ``schema.column_sizes``."""

    varchar: Mapping[str, int] = field(default_factory=dict)
    long: Mapping[str, int] = field(default_factory=dict)
    default: int | None = None
    all_long: bool = False


def _text_type(name: str, dialect: Dialect, sizes: TextSizes) -> str:
    if dialect is SPANNER:
        return dialect.types["string"]
    if sizes.all_long:
        sized = dialect is VERTICA and sizes.default
        return f"{dialect.all_text}({sizes.default})" if sized else dialect.all_text
    key = name.upper()
    if key in sizes.varchar:
        return f"VARCHAR({sizes.varchar[key]})"
    if key in sizes.long:
        return f"{dialect.long_text}({sizes.long[key]})"
    return f"VARCHAR({sizes.default})" if sizes.default else dialect.plain_text or dialect.types["string"]


def column_types(schema: T.StructType, dialect: Dialect, sizes: TextSizes = TextSizes()) -> dict[str, str]:
    """SQL type of every column, in schema order."""
    result = {}
    for f in schema:
        kind, _, rest = f.dataType.simpleString().partition("(")
        kind = kind.split("<")[0].replace("timestamp_ntz", "timestamp")
        if kind.startswith("varchar") or kind.startswith("char"):
            kind = "string"
        if kind == "string":
            result[f.name] = _text_type(f.name, dialect, sizes)
            continue
        if kind not in dialect.types:
            raise ValueError(f"{dialect.name} has no type for {f.dataType.simpleString()} ({f.name})")
        precision = f"({rest}" if rest and kind == "decimal" and dialect.precise else ""
        result[f.name] = dialect.types[kind] + precision
    return result


def create_table(table: str, types: Mapping[str, str], dialect: Dialect, keys: Sequence[str] = (), partition_by: str | None = None) -> str:
    """CREATE TABLE text; Spanner names the key with the table."""
    columns = ", ".join(f"{dialect.quoted(c)} {t}" for c, t in types.items())
    tail = f" PRIMARY KEY ({', '.join(keys)})" if dialect is SPANNER and keys else ""
    part = f" PARTITION BY {partition_by}" if partition_by else ""
    return f"CREATE TABLE {table} ({columns}){tail}{part}"


def create_schema(name: str, dialect: Dialect) -> str:
    return f"CREATE {'DATABASE' if dialect is MYSQL else 'SCHEMA'} IF NOT EXISTS {name}"


def add_primary_key(table: str, keys: Sequence[str], dialect: Dialect) -> str:
    listed = ", ".join(keys)
    if dialect is VERTICA:
        return f"ALTER TABLE {table} ADD CONSTRAINT pk PRIMARY KEY ({listed}) ENABLED"
    return f"ALTER TABLE {table} ADD PRIMARY KEY ({listed})"


def drop_table(table: str) -> str:
    return f"DROP TABLE IF EXISTS {table}"


def truncate_table(table: str) -> str:
    return f"TRUNCATE TABLE {table}"


def rename_into(staging_schema: str, working: str, schema: str, table: str, dialect: Dialect) -> list[str]:
    """Statements that make the loaded working table the target, across schemas if need be."""
    if dialect is MYSQL:
        return [f"RENAME TABLE {staging_schema}.{working} TO {schema}.{table}"]
    moves = [f"ALTER TABLE {staging_schema}.{working} RENAME TO {table}"]
    if staging_schema.lower() != schema.lower():
        moves.append(f"ALTER TABLE {staging_schema}.{table} SET SCHEMA {schema}")
    return moves


def merge_statement(target: str, delta: str, columns: Sequence[str], keys: Sequence[str], dialect: Dialect) -> str:
    """One set-based upsert of a staged delta.

    MySQL finds the row by the table's own primary key; elsewhere the natural keys decide.
    """
    names = ", ".join(columns)
    if dialect is MYSQL:
        updates = ", ".join(f"{c} = VALUES({c})" for c in columns)
        return f"INSERT INTO {target} ({names}) SELECT {names} FROM {delta} ON DUPLICATE KEY UPDATE {updates}"
    if not keys:
        raise ValueError("a merge needs natural keys")
    on = " AND ".join(f"T.{k} = D.{k}" for k in keys)
    updates = ", ".join(f"{c} = D.{c}" for c in columns)
    values = ", ".join(f"D.{c}" for c in columns)
    return (
        f"MERGE INTO {target} AS T USING {delta} AS D ON ({on}) "
        f"WHEN MATCHED THEN UPDATE SET {updates} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def index_statements(table: str, columns: Sequence[str], existing: bool = False) -> list[str]:
    """Index on the listed columns, dropped first where there is one."""
    name = f"idx_{table.split('.')[-1]}_{'_'.join(columns)}"
    made = f"CREATE INDEX {name} ON {table} ({', '.join(columns)})"
    return [f"DROP INDEX {name}", made] if existing else [made]


def write_options(text: str | None) -> dict[str, str]:
    """``"numPartitions=2;batchsize=10000"`` to options; entries without a value are left out."""
    entries = (e.partition("=") for e in (text or "").split(";"))
    return {k.strip(): v.strip() for k, eq, v in entries if eq and k.strip()}
