"""Loading one table from another: refresh, append, merge, history and deduplication."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.filters import high_water_filter
from quayside.sinks.filetable import FileTable

# Date parts a partition column may be derived by.
PARTITION_FORMATS = ("dd", "MM", "yyyy", "yyyyMM", "MMdd", "yyyyMMdd")
# Buckets of keys by which copies are compared.
BUCKETS = 256
# Versions and changes that a task of a history merge sorts, on average.
TASK_ROWS = 250_000
VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"


def full_refresh(df: DataFrame, table: str, base: str, fmt: str = "parquet") -> str:
    """Replace a table's contents and return the folder they lie in.

    The rows go to a new folder below ``base``; only when they are all written does the table
    point there. The old folder is never touched, so ``df`` may read the table itself and a job
    that dies half-way leaves the table as it was.
    """
    spark = df.sparkSession
    folder = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.format(fmt).save(folder)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source=fmt)
    return folder


def incremental_append(source: DataFrame, table: FileTable, marks: Sequence[str], last, batch: str | None = None) -> bool:
    """Append the rows past the last high-water mark, once.

    ``batch`` names the load; unnamed, it is known by its marks and the last value. A load that is in
    the table's log already is left out, and false is returned.
    """
    return table.append(high_water_filter(source, marks, last), batch or f"{','.join(marks)}>{last}")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "latest") -> DataFrame:
    """One row per key: the latest or the earliest by ``order``.

    ``order`` should end in a column that breaks ties. Each task first keeps one row per key, so
    a key with very many copies costs no more to shuffle than any other.
    """
    pick = {"latest": F.max_by, "earliest": F.min_by}[keep]
    rest = [c for c in df.columns if c not in keys]
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def merge_scd1(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert by key: delta rows replace those with their key, the others are added.

    ``delta`` holds one row per key. A null key matches nothing, as in a SQL MERGE. One full outer
    join: either side is read and shuffled once.
    """
    columns = target.columns
    new = delta.select(*[F.col(c).alias(f"_new_{i}") for i, c in enumerate(columns)], F.lit(True).alias("_is_new"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_new_{columns.index(k)}") for k in keys])
    chosen = [F.when(F.col("_is_new"), F.col(f"_new_{i}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(columns)]
    return target.join(new, same, "full_outer").select(*chosen)


def merge_soft_delete(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], deleted_when: str, flag: str = "is_deleted"
) -> DataFrame:
    """Upsert that marks rows as deleted instead of removing them."""
    marked = delta.withColumn(flag, F.coalesce(F.expr(deleted_when), F.lit(False)))
    have = target if flag in target.columns else target.withColumn(flag, F.lit(False))
    return merge_scd1(have, marked, keys)


def live_rows(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.where(~F.coalesce(F.col(flag), F.lit(False))).drop(flag)


def merge_partitions(
    spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], partition: str, staging: str
) -> None:
    """Upsert into a partitioned folder, rewriting only the partitions the delta falls into.

    A key must stay in its partition. The touched partitions are merged into ``staging`` first,
    since a folder cannot be overwritten while it is read, then replace the old ones.
    """
    target = spark.read.parquet(path)
    touched = target.join(delta.select(partition).distinct(), partition, "left_semi").select(*target.columns)
    merge_scd1(touched, delta, [partition, *keys]).write.parquet(staging)
    (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def merge_scd2(history: DataFrame, delta: DataFrame, keys: Sequence[str], at: str, scd1_columns: Sequence[str] = ()) -> DataFrame:
    """Keep every version of a row over time.

    ``history`` has the keys, the attributes and ``valid_from``, ``valid_to`` (null: open),
    ``is_current``. ``delta`` has the keys, the attributes and the instant ``at`` each row holds
    from; a key may come several times. A changed row cuts the version holding at that instant, even
    one closed long ago; a row equal to what holds just before it changes nothing (null equals
    null); a row that starts exactly with a version corrects it; a key or time without a version
    gets one that lasts until the next begins. A null ``valid_from`` is an open start. A version
    that ends where it starts holds at no instant: no change cuts it, and it stays as it is.
    ``scd1_columns`` are not kept over time: a row that differs in these alone overwrites them in
    the version it falls into. A null key matches nothing: such rows come in as new versions.

    History and delta are put side by side and shuffled by key once; versions and changes are then
    read in the order of time, so no key's rows are held in memory. Both are counted first: tasks are
    as many as leave each ``TASK_ROWS`` rows, since bytes of a shuffle, well packed, say little of what
    the sorts of a task take.
    """
    keys = list(keys)
    attrs = [c for c in delta.columns if c not in keys and c != at]
    kept, loose = [c for c in attrs if c not in scd1_columns], [c for c in attrs if c in scd1_columns]
    span = F.struct(F.col(VALID_FROM).alias("start"), F.col(VALID_TO).alias("end"), F.col(IS_CURRENT).alias("current"))
    old = history.select(*keys, *attrs, F.col(VALID_FROM).alias("_t"), F.lit(0).alias("_new"), span.alias("_span"),
                         F.coalesce(F.col(VALID_FROM) >= F.col(VALID_TO), F.lit(False)).alias("_idle"))
    new = delta.select(*keys, *attrs, F.col(at).alias("_t"), F.lit(1).alias("_new"), F.lit(False).alias("_idle"))
    rows = old.unionByName(new, allowMissingColumns=True)
    lost = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    # a null key is no key: each such row is told apart and stands alone
    rows = rows.withColumn("_alone", F.when(lost, F.concat_ws("-", F.monotonically_increasing_id(), "_new")).otherwise(""))

    tasks = max(1, -(-(history.count() + delta.count()) // TASK_ROWS))
    rows = rows.repartition(tasks, *keys, "_alone")

    def walk(*more, back=False):
        order = [F.col("_t").desc(), F.col("_new").desc(), *[F.col(a).desc() for a in attrs]] if back else ["_t", "_new", *attrs]
        return Window.partitionBy(*keys, "_alone", *more).orderBy(*order)

    upto, later = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    holding = F.last(F.when(~F.col("_idle"), F.col("_span")), ignorenulls=True).over(walk().rowsBetween(*upto))
    rows = rows.withColumn("_span", F.when(F.col("_idle"), F.col("_span")).otherwise(holding))
    held = F.col("_span").isNotNull() & (F.col("_span.end").isNull() | (F.col("_t") < F.col("_span.end")))
    rows = rows.withColumns({"_from": F.col("_span.start"), "_held": held | (F.col("_new") == 0)})
    within = walk("_from", "_held", "_idle")
    same = F.equal_null(F.struct(*kept), F.lag(F.struct(*kept)).over(within)) if kept else F.lag(F.lit(1)).over(within).isNotNull()
    rows = rows.withColumn("_cuts", (F.col("_new") == 0) | ~F.coalesce(same, F.lit(False)))
    if loose:
        rows = rows.withColumn("_run", F.sum(F.col("_cuts").cast("int")).over(within.rowsBetween(*upto)))
        whole = walk("_from", "_held", "_idle", "_run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns({c: F.last(c).over(whole) for c in loose})
    # looking back from the end, the nearest later change and the nearest later version
    change = F.last(F.when(F.col("_cuts") & (F.col("_new") == 1), F.col("_t")), ignorenulls=True)
    version = F.last(F.when(F.col("_new") == 0, F.col("_t")), ignorenulls=True)
    rows = rows.withColumns({
        "_change": change.over(walk("_from", "_held", "_idle", back=True).rowsBetween(*later)),
        "_version": version.over(walk(back=True).rowsBetween(*later)),
    })
    ends = F.when(F.col("_held"), F.coalesce("_change", F.col("_span.end"))).otherwise(F.least("_change", "_version"))
    open_ = F.when(F.col("_held"), F.col("_change").isNull() & F.col("_span.current")).otherwise(ends.isNull())
    # what a change at its own start leaves without length goes; all other history stays
    left = rows.where(F.col("_cuts") & ~F.coalesce(F.col("_change") == F.col("_t"), F.lit(False)))
    return left.select(*keys, *attrs, F.col("_t").alias(VALID_FROM), ends.alias(VALID_TO), open_.alias(IS_CURRENT))


def with_partition(df: DataFrame, parent: str, fmt: str, name: str) -> DataFrame:
    """Add a partition column derived from a date part of another column."""
    if fmt not in PARTITION_FORMATS:
        raise ValueError(f"partition format {fmt!r} is not one of {', '.join(PARTITION_FORMATS)}")
    return df.withColumn(name, F.date_format(parent, fmt))


def between_dates(df: DataFrame, parent: str, name: str, fmt: str, first: str, last: str) -> DataFrame:
    """Rows from ``first`` to ``last`` day, also stated on the partition column so folders are skipped."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    inside = (F.col(parent) >= low) & (F.col(parent) < F.date_add(high, 1))
    if fmt in ("yyyy", "yyyyMM", "yyyyMMdd"):
        value = F.col(name).cast("int")
        inside &= (value >= F.date_format(low, fmt).cast("int")) & (value <= F.date_format(high, fmt).cast("int"))
    return df.where(inside)


def sorted_write(df: DataFrame, path: str, sort_by: Sequence[str], partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write rows sorted within each file: enough for min/max skipping, with no global sort."""
    (df.sortWithinPartitions(*partition_by, *sort_by).write.format(fmt).partitionBy(*partition_by).save(path))


def replicate(
    pairs: Iterable[tuple[str, str]],
    read: Callable[[str, str], DataFrame],
    write: Callable[[DataFrame, str, str], None],
    read_back: Callable[[str, str], DataFrame],
) -> list[tuple[str, str, int, int]]:
    """Copy listed (schema, table) pairs; per pair the rows read and the rows found in the copy.

    The rows read are counted while they are written, not by a second scan.
    """
    report = []
    for schema, table in pairs:
        seen = Observation()
        write(read(schema, table).observe(seen, F.count(F.lit(1)).alias("n")), schema, table)
        report.append((schema, table, seen.get["n"], read_back(schema, table).count()))
    return report


def digests(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per bucket of keys (``_bucket, n, mark``) a digest of its rows that does not depend on their order.

    The sum and the exclusive or of row hashes; columns are taken by name, so their order is free.
    """
    whole = F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")
    rows = df.select(bucket_of(keys, buckets).alias("_bucket"), whole.alias("h"), F.xxhash64(F.lit("x"), *sorted(df.columns)).alias("x"))
    return rows.groupBy("_bucket").agg(F.count("*").alias("n"), F.struct(F.sum("h").alias("sum"), F.bit_xor("x").alias("xor")).alias("mark"))


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def differing(source: DataFrame, copy: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets whose contents differ. Digests alone travel; at most ``buckets`` numbers come back."""
    a, b = digests(source, keys, buckets), digests(copy, keys, buckets).toDF("_b", "_n", "_mark")
    same = F.col("mark").eqNullSafe(F.col("_mark")) & F.col("n").eqNullSafe(F.col("_n"))
    apart = a.join(b, F.col("_bucket") == F.col("_b"), "full_outer").where(~same).select(F.coalesce("_bucket", "_b").alias("b"))
    return sorted(r["b"] for r in apart.collect())  # bound: the number of buckets


def replicate_into(source: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Bring a copy kept in bucket folders up to date; returns the buckets that were written.

    Contents are compared by bucket, both sides where they are, and only buckets that differ are
    copied. A copy that does not exist yet is written whole. Columns are those of ``source``.
    """
    spark = source.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marked = source.withColumn("_bucket", bucket_of(keys, buckets))
    have = spark.read.schema(marked.schema).parquet(path) if fs.exists(folder) else spark.createDataFrame([], marked.schema)
    apart = differing(source, have.drop("_bucket"), keys, buckets)
    if apart:
        changed = marked.where(F.col("_bucket").isin(apart))
        writer = changed.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_bucket").parquet(path)
        filled = {r["_bucket"] for r in changed.select("_bucket").distinct().collect()}  # bound: the number of buckets
        for bucket in set(apart) - filled:  # nothing is left of these in the source
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_bucket={bucket}"), True)
    return apart


def templated(spark: SparkSession, template: str, rows: Iterable[Mapping[str, str]], **views: DataFrame) -> DataFrame:
    """One SQL template run for each spec row, results united.

    Values are bound as parameters; table and column names through ``IDENTIFIER(:name)``.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    parts = [spark.sql(template, args=dict(row)) for row in rows]
    return reduce(DataFrame.unionByName, parts)
