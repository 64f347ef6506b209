"""Table loads. The deltas are whole slices of the order table, not hand-made rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.operators import load, schema
from quayside.plans.registry import query
from quayside.sinks.filetable import FileTable

# Urgent orders come back repriced, each twice with a later second copy; finished orders come
# again under new keys.
DELTA = """
  SELECT o_orderkey AS k, o_custkey AS cust, concat(o_orderstatus, 'x') AS status,
         cast(o_totalprice AS DECIMAL(18, 2)) * 2 AS price, o_orderdate AS seen FROM orders WHERE o_orderpriority LIKE '1%'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS DECIMAL(18, 2)) * 3,
         o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderpriority LIKE '1%'
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS DECIMAL(18, 2)) * 1, o_orderdate
  FROM orders WHERE o_orderstatus = 'F'"""

TARGET = "SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status, cast(o_totalprice AS DECIMAL(18, 2)) * 1 AS price, o_orderdate AS seen FROM orders"

_OUT = "k, cust, status, CAST(price AS DOUBLE) AS price, CAST(seen AS VARCHAR) AS seen"
_LATEST = "SELECT k, max_by(cust, seen) AS cust, max_by(status, seen) AS status, max_by(price, seen) AS price, max(seen) AS seen FROM delta GROUP BY k"


def _shown(df):
    return df.select("k", "cust", "status", F.col("price").cast("double").alias("price"), F.col("seen").cast("string").alias("seen"))


def _table(t, label):
    return f"{label}_{uuid.uuid4().hex[:12]}", t.scratch(label)


@query("f1_full_refresh", "SELECT o_orderkey, o_totalprice + 1 AS price FROM orders WHERE o_orderstatus <> 'P'")
def full_refresh(t):
    """The second load reads the table it replaces."""
    table, base = _table(t, "refresh")
    load.full_refresh(t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price")), table, base)
    again = t.spark.table(table).where("o_orderstatus <> 'P'").withColumn("price", F.col("price") + 1)
    load.full_refresh(again, table, base)
    return t.spark.table(table).select("o_orderkey", "price")


@query("f2_incremental_append", "SELECT o_orderkey, o_totalprice FROM orders")
def incremental_append(t):
    """An older load plus everything past its high-water mark, sent twice, is the whole table, each row once."""
    import datetime

    table, mark = FileTable(t.spark, t.scratch("append")), datetime.datetime(1997, 6, 30)
    table.append(t.orders.where(F.col("o_orderdate") <= F.lit(mark)), "first")
    for _ in range(2):
        load.incremental_append(t.orders, table, ["o_orderdate"], mark)
    return table.read().select("o_orderkey", "o_totalprice")


@query(
    "f3_merge_scd1",
    f"""WITH target AS ({TARGET}), delta AS ({DELTA}), latest AS ({_LATEST})
        SELECT {_OUT} FROM target WHERE k NOT IN (SELECT k FROM latest)
        UNION ALL SELECT {_OUT} FROM latest""",
)
def merge_scd1(t):
    delta = load.dedup(t.sql(DELTA), ["k"], ["seen"])
    return _shown(load.merge_scd1(t.sql(TARGET), delta, ["k"]))


# Two versions of each order: 30 days as new, then as it is now. The changes fall after, inside,
# before and exactly at the start of a version, or change nothing; customers are new keys.
HISTORY = """
  SELECT o_orderkey AS k, 'N' AS status, CAST(NULL AS BIGINT) AS owner, o_orderdate AS valid_from,
         o_orderdate + INTERVAL 30 DAY AS valid_to, false AS is_current FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderstatus, o_custkey, o_orderdate + INTERVAL 30 DAY, CAST(NULL AS TIMESTAMP), true FROM orders"""
CHANGES = """
  SELECT o_orderkey AS k,
         CASE WHEN o_orderpriority LIKE '5%' THEN o_orderstatus ELSE 'Z' END AS status,
         CASE WHEN o_orderpriority LIKE '2%' THEN NULL ELSE o_custkey END AS owner,
         CASE WHEN o_orderpriority LIKE '1%' THEN o_orderdate + INTERVAL 60 DAY
              WHEN o_orderpriority LIKE '2%' THEN o_orderdate + INTERVAL 10 DAY
              WHEN o_orderpriority LIKE '3%' THEN o_orderdate - INTERVAL 5 DAY
              WHEN o_orderpriority LIKE '4%' THEN o_orderdate + INTERVAL 30 DAY
              ELSE o_orderdate + INTERVAL 45 DAY END AS since
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT -1 - c_custkey, 'C', CAST(c_nationkey AS BIGINT), TIMESTAMP '2000-01-01 00:00:00' FROM customer"""


@query(
    "f4_merge_scd2",
    f"""WITH h AS ({HISTORY}), d AS ({CHANGES}), j AS (
          SELECT h.*, d.status AS ns, d.owner AS no, d.since,
                 coalesce(h.valid_from <= d.since AND (h.valid_to IS NULL OR d.since < h.valid_to), false) AS holds,
                 coalesce(h.valid_from <= d.since AND (h.valid_to IS NULL OR d.since < h.valid_to)
                   AND (h.status IS DISTINCT FROM d.status OR h.owner IS DISTINCT FROM d.owner), false) AS changed
          FROM h LEFT JOIN d ON h.k = d.k),
        f AS (SELECT k, bool_or(holds) AS found, min(CASE WHEN valid_from > since THEN valid_from END) AS nxt FROM j GROUP BY k),
        r AS (
          SELECT k, status, owner, valid_from, valid_to, is_current FROM j WHERE NOT changed
          UNION ALL SELECT k, status, owner, valid_from, since, false FROM j WHERE changed AND valid_from < since
          UNION ALL SELECT k, ns, no, since, valid_to, is_current FROM j WHERE changed
          UNION ALL SELECT d.k, d.status, d.owner, d.since, f.nxt, f.nxt IS NULL FROM d LEFT JOIN f ON d.k = f.k WHERE NOT coalesce(f.found, false))
        SELECT k, status, owner, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM r""",
)
def merge_scd2(t):
    history = t.sql(HISTORY.replace("CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP_NTZ)"))
    changes = t.sql(CHANGES.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    merged = load.merge_scd2(history, changes, ["k"], "since")
    return merged.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


# Orders of one customer come back closed, and a few keys are new.
FEW = """
  SELECT o_orderkey AS k, o_custkey AS cust, 'closed' AS status, cast(o_totalprice AS DECIMAL(18, 2)) * 5 AS price, o_orderdate AS seen
  FROM orders WHERE o_orderkey <= 20
  UNION ALL
  SELECT -1 - n_nationkey, n_regionkey, n_name, CAST(1 AS DECIMAL(18, 2)) * 1, TIMESTAMP '2000-01-01 00:00:00' FROM nation"""


def _indexed(t, rows, keys, files=16):
    """A table of several files by ranges of its key; of more, where they would have over ``FILE_ROWS`` rows."""
    table = FileTable(t.spark, t.scratch("indexed"), keys)
    staged = table.stage(rows, files=max(files, table._files_for(rows)))
    table.commit(table.head(), staged, rows.schema.json(), "first")
    return table


@query(
    "f3_merge_scd1_files",
    f"""WITH target AS ({TARGET}), few AS ({FEW})
        SELECT {_OUT}, k <= 20 AS rewritten FROM target WHERE k NOT IN (SELECT k FROM few)
        UNION ALL SELECT {_OUT}, true FROM few""",
)
def merge_scd1_files(t):
    """A small delta rewrites the files that may hold its keys; most stay what they are."""
    table = _indexed(t, t.sql(TARGET), ["k"])
    few = t.sql(FEW.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    before = table.head()
    gone = table.merge(few, lambda old, new: load.merge_scd1(old, new, ["k"]))
    if not gone or len(gone) > len(before.files) // 4:
        raise ValueError(f"{len(gone)} of {len(before.files)} files were rewritten")
    return _shown(table.read()).withColumn("rewritten", (F.col("k") <= 20))


@query(
    "f4_merge_scd2_files",
    f"""WITH h AS ({HISTORY}), d AS (SELECT k, 'Q' AS status, max(owner) AS owner, max(valid_from) + INTERVAL 5 DAY AS since FROM ({HISTORY}) WHERE k <= 20 GROUP BY k)
        SELECT h.k, h.status, h.owner, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(CASE WHEN h.is_current THEN coalesce(d.since, valid_to) ELSE valid_to END AS VARCHAR) AS valid_to, h.is_current AND d.k IS NULL AS is_current
        FROM h LEFT JOIN d ON h.k = d.k
        UNION ALL SELECT k, status, owner, CAST(since AS VARCHAR), NULL, true FROM d""",
)
def merge_scd2_files(t):
    """Changes of a few keys rewrite the history files of those keys alone."""
    history = t.sql(HISTORY.replace("CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP_NTZ)"))
    table = _indexed(t, history, ["k"])
    changes = history.where("k <= 20").groupBy("k").agg(
        F.lit("Q").alias("status"), F.max("owner").alias("owner"), (F.max("valid_from") + F.expr("interval 5 days")).alias("since"))
    gone = table.merge(changes, lambda old, new: load.merge_scd2(old, new, ["k"], "since"))
    if not gone or len(gone) > 4:
        raise ValueError(f"{len(gone)} files were rewritten")
    return table.read().withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query("f5_dedup_latest", f"WITH delta AS ({DELTA}), latest AS ({_LATEST}) SELECT {_OUT} FROM latest")
def dedup_latest(t):
    return _shown(load.dedup(t.sql(DELTA), ["k"], ["seen"]))


@query(
    "f5_dedup_earliest",
    """SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def dedup_earliest(t):
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    return load.dedup(rows, ["user_id"], ["ts", "event_id"], "earliest").withColumn("ts", F.col("ts").cast("string"))


@query(
    "f6_soft_delete",
    f"""WITH target AS ({TARGET}), delta AS ({DELTA}), latest AS ({_LATEST})
        SELECT {_OUT}, false AS is_deleted FROM target WHERE k NOT IN (SELECT k FROM latest)
        UNION ALL SELECT {_OUT}, status = 'F' AS is_deleted FROM latest""",
)
def soft_delete(t):
    delta = load.dedup(t.sql(DELTA), ["k"], ["seen"])
    merged = load.merge_soft_delete(t.sql(TARGET), delta, ["k"], "status = 'F'")
    return merged.withColumns({"price": F.col("price").cast("double"), "seen": F.col("seen").cast("string")})


@query(
    "f6_live_rows",
    f"""WITH target AS ({TARGET}), delta AS ({DELTA}), latest AS ({_LATEST})
        SELECT {_OUT} FROM target WHERE k NOT IN (SELECT k FROM latest)
        UNION ALL SELECT {_OUT} FROM latest WHERE status <> 'F'""",
)
def live_rows(t):
    delta = load.dedup(t.sql(DELTA), ["k"], ["seen"])
    return _shown(load.live_rows(load.merge_soft_delete(t.sql(TARGET), delta, ["k"], "status = 'F'")))


@query(
    "f7_derived_partition",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m')::INTEGER AS month FROM orders
       WHERE o_orderdate >= DATE '1997-02-10' AND o_orderdate < DATE '1997-05-21'""",
)
def derived_partition(t):
    path = t.scratch("partitioned")
    parted = load.with_partition(t.orders, "o_orderdate", "yyyyMM", "month")
    parted.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    back = t.spark.read.parquet(path)
    return load.between_dates(back, "o_orderdate", "month", "yyyyMM", "1997-02-10", "1997-05-20").select("o_orderkey", "month")


@query("f8_sort_by_columns", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def sort_by_columns(t):
    path = t.scratch("sorted")
    load.sorted_write(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), path, ["l_orderkey", "l_linenumber"])
    return t.spark.read.parquet(path)


_COPIED = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "documents"]


@query(
    "f9_table_replicate",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_read, count(*) AS n_copied, true AS same FROM {n}" for n in _COPIED),
)
def table_replicate(t):
    base = t.scratch("replica")
    report = load.replicate(
        [("db", n) for n in _COPIED],
        lambda s, n: getattr(t, n),
        lambda df, s, n: df.write.parquet(f"{base}/{s}/{n}"),
        lambda s, n: t.spark.read.parquet(f"{base}/{s}/{n}"))
    rows = [(n, a, b, a == b) for _, n, a, b in report]
    return t.spark.createDataFrame(rows, "table_name string, n_read long, n_copied long, same boolean")


@query("f9_replicate_changes", "SELECT o_orderkey, o_custkey, o_totalprice, true AS few FROM orders")
def replicate_changes(t):
    """A copy with one altered, one lost and one strange row is found out and mended where it differs."""
    path, rows = t.scratch("copy"), t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    first = rows.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).head()
    altered = F.when(F.col("o_orderkey") == first["low"], -1.0).otherwise(F.col("o_totalprice")).alias("o_totalprice")
    strange = t.spark.range(1).select((F.lit(first["high"]) + 1).alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit(1.0).alias("o_totalprice"))
    load.replicate_into(rows.where(F.col("o_orderkey") != first["high"]).select("o_orderkey", "o_custkey", altered).unionByName(strange), path, ["o_orderkey"], 32)
    mended = load.replicate_into(rows, path, ["o_orderkey"], 32)
    few = 0 < len(mended) <= 3 and load.replicate_into(rows, path, ["o_orderkey"], 32) == []
    return t.spark.read.schema(rows.schema).parquet(path).select(*rows.columns, F.lit(few).alias("few"))


@query(
    "f10_templated_projection",
    """SELECT 'priority' AS what, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY 2
       UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY 2""",
)
def templated_projection(t):
    template = "SELECT :what AS what, IDENTIFIER(:column) AS v, count(*) AS n FROM IDENTIFIER(:table) GROUP BY ALL"
    rows = [
        {"what": "priority", "table": "orders", "column": "o_orderpriority"},
        {"what": "status", "table": "orders", "column": "o_orderstatus"},
        {"what": "segment", "table": "customer", "column": "c_mktsegment"},
    ]
    return load.templated(t.spark, template, rows, orders=t.orders, customer=t.customer)


@query("f11_export_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def export_columns(t):
    path = t.scratch("export")
    scan = schema.add_audit(t.orders.select("o_orderkey", "o_totalprice"))
    schema.drop_audit(scan).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)
