"""Tables in a database: overwrite by swap, append, and merge by staging.

Spark writes rows in parallel; the few statements around a load run on one connection through
``execute``, so what is sent can be inspected and replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.schema import uppercase_columns, widen_floats
from quayside.sinks import dialects as d

# Suffixes of working tables.
TEMP, DELTA = "_temp", "_delta"
MODES = ("overwrite", "append", "merge")


def _connect(spark: SparkSession, url: str, properties: Mapping[str, str]):
    given = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, v)
    return spark._jvm.java.sql.DriverManager.getConnection(url, given)


def jvm_statements(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Callable[[str], None]:
    """Run statements on the driver through the JDBC driver Spark uses."""
    def execute(statement: str) -> None:
        connection = _connect(spark, url, properties)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    return execute


def jvm_table_exists(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Callable[[str], bool]:
    """Ask the database's catalog for a table.

    Only its answer counts: a server that cannot be reached, a wrong password or a missing right
    raise, and never pass for a missing table.
    """
    def exists(name: str) -> bool:
        connection = _connect(spark, url, properties)
        try:
            return listed(connection.getMetaData(), name)
        finally:
            connection.close()

    return exists


def listed(catalog, name: str) -> bool:
    """Whether a JDBC catalog lists ``schema.table``, spelt as given or in one case.

    Some databases call a schema a catalog, so both places are asked.
    """
    mark = catalog.getSearchStringEscape()

    def plain(text: str) -> str:
        for c in (mark, "_", "%"):
            text = text.replace(c, mark + c)
        return text

    schema, _, table = name.rpartition(".")
    for spell in (str, str.upper, str.lower):
        for place in ((None, plain(spell(schema))), (spell(schema), None)):
            found = catalog.getTables(*place, plain(spell(table)), None)
            try:
                if found.next():
                    return True
            finally:
                found.close()
    return False


@dataclass
class JdbcTarget:
    """One table of a database and how it is loaded."""

    dialect: d.Dialect
    schema: str
    table: str
    execute: Callable[[str], None]
    exists: Callable[[str], bool]
    save: Callable[[DataFrame, str, Mapping[str, str]], None]
    mode: str = "overwrite"
    staging_schema: str | None = None
    natural_keys: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    index: Sequence[str] = ()
    partition_by: str | None = None
    user_managed: bool = False
    create_if_missing: bool = True
    create_schema: bool = False
    uppercase: bool = False
    sizes: d.TextSizes = d.TextSizes()
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        self.mode = self.mode.lower()
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {', '.join(MODES)}")
        if self.mode == "merge" and not self.natural_keys:
            raise ValueError("a merge needs natural keys")
        self.staging_schema = self.staging_schema or self.schema

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}"

    def write(self, df: DataFrame) -> None:
        if self.uppercase:
            df = uppercase_columns(df)
        if self.dialect is d.SPANNER:
            df = widen_floats(df)
        there = self.exists(self.name)
        if self.user_managed and not there:
            raise ValueError(f"{self.name} is managed by its user and does not exist")
        if not there and self.mode != "overwrite":
            if not self.create_if_missing:
                raise ValueError(f"{self.name} does not exist")
            self._make(df)
        elif self.mode == "overwrite" and self.user_managed:
            self.execute(d.truncate_table(self.name))
            self.save(df, self.name, self.options)
        elif self.mode == "overwrite":
            self._swap(df, self.table)
        elif self.mode == "append":
            self.save(df, self.name, self.options)
        else:
            self._merge(df)

    def _create(self, df: DataFrame, name: str) -> None:
        if self.create_schema:
            self.execute(d.create_schema(name.split(".")[0], self.dialect))
        types = d.column_types(df.schema, self.dialect, self.sizes)
        partition = self.partition_by if self.mode == "overwrite" else None
        self.execute(d.drop_table(name))
        self.execute(d.create_table(name, types, self.dialect, self.primary_key, partition))

    def _make(self, df: DataFrame) -> None:
        """Create the target in its place and fill it; nothing is dropped, so a table that is there
        after all makes the database refuse."""
        if self.create_schema:
            self.execute(d.create_schema(self.schema, self.dialect))
        types = d.column_types(df.schema, self.dialect, self.sizes)
        self.execute(d.create_table(self.name, types, self.dialect, self.primary_key, None))
        if self.primary_key and self.dialect is not d.SPANNER:
            self.execute(d.add_primary_key(self.name, self.primary_key, self.dialect))
        self.save(df, self.name, self.options)
        self._add_indexes()

    def _add_indexes(self) -> None:
        if self.index:
            for statement in d.index_statements(self.name, self.index):
                self.execute(statement)

    def _swap(self, df: DataFrame, table: str) -> None:
        """Load a working table, then put it in the place of the old one."""
        working = table + TEMP
        staged = f"{self.staging_schema}.{working}"
        self._create(df, staged)
        if self.primary_key and self.dialect is not d.SPANNER:
            self.execute(d.add_primary_key(staged, self.primary_key, self.dialect))
        self.save(df, staged, self.options)
        if self.staging_schema != self.schema:
            self.execute(d.drop_table(f"{self.staging_schema}.{table}"))
        self._drop_target(table)
        for statement in d.rename_into(self.staging_schema, working, self.schema, table, self.dialect):
            self.execute(statement)
        self._add_indexes()

    def _drop_target(self, table: str) -> None:
        """MySQL loads may lack the right to drop in the target schema; the rename then decides."""
        try:
            self.execute(d.drop_table(f"{self.schema}.{table}"))
        except Exception:
            if self.dialect is not d.MYSQL or self.staging_schema == self.schema:
                raise

    def _merge(self, df: DataFrame) -> None:
        staged = f"{self.staging_schema}.{self.table}{DELTA}"
        self._create(df, staged)
        self.save(df, staged, self.options)
        self.execute(d.merge_statement(self.name, staged, df.columns, self.natural_keys, self.dialect))
        self.execute(d.drop_table(staged))


def jdbc_target(spark: SparkSession, url: str, dialect: str, schema: str, table: str, properties: Mapping[str, str], options: str = "", **settings) -> JdbcTarget:
    """A target reached over JDBC; ``options`` as in ``"numPartitions=2;batchsize=10000"``."""
    properties = dict(properties)

    def save(df: DataFrame, name: str, given: Mapping[str, str]) -> None:
        df.write.options(**given).jdbc(url, name, mode="append", properties=properties)

    return JdbcTarget(
        d.DIALECTS[dialect], schema, table, jvm_statements(spark, url, properties), jvm_table_exists(spark, url, properties), save,
        options=d.write_options(options), **settings)
