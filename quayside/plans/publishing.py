"""Sinks and streams over the order, customer and event tables, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators.schema import ColumnSpec
from quayside.plans.registry import query
from quayside.session import saved
from quayside.sinks import document, files, messages, partitioned, staged
from quayside.sinks.filetable import FileTable
from quayside.sources.listing import list_files
from quayside.streaming import ingest


def _put(rows, path, mode="append", **options):
    staged.register(rows.sparkSession)
    rows.write.format("keyed_folder").mode(mode).options(path=path, **options).save()


@query("g8_partition_upsert", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def partition_upsert(t):
    """Orders with stale prices, then those that changed: each job is committed once, the later row counts."""
    path, rows = t.scratch("service"), t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = F.col("o_orderstatus") == "F"
    _put(rows.withColumn("o_totalprice", F.when(changed, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))), path, keys="o_orderkey", batch=5000)
    _put(rows.where(changed), path, keys="o_orderkey", batch=1000)
    return staged.current(t.spark, path, ["o_orderkey"])


@query(
    "g9_chunked_upsert",
    "SELECT l_orderkey, l_linenumber, l_quantity, true AS within_limit FROM lineitem",
)
def chunked_upsert(t):
    """No batch has more than 1,500 cells: 499 rows of three columns."""
    path = t.scratch("chunks")
    _put(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), path, cells=1500)
    told = staged.receipts(t.spark, path).select((F.col("largest").between(1, 499) & (F.col("rows") <= F.col("batches") * 499)).alias("within_limit"))
    return staged.committed(t.spark, path).drop("_at", "_job").join(told)


@query("g17_retry_policy", "SELECT c_custkey, c_name FROM customer")
def retry_policy(t):
    """Loads that run side by side take each other's place in the log and try again; each row arrives once."""
    from concurrent.futures import ThreadPoolExecutor

    table = FileTable(t.spark, t.scratch("contended"), retry=partitioned.RetryPolicy(first=0.02, total=30.0))
    rows = t.customer.select("c_custkey", "c_name")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: table.append(rows.where(F.col("c_custkey") % 4 == i), f"part {i}"), range(4)))
    return table.read()


@query("g10_parallelism_control", "SELECT o_orderkey, true AS spread_ok FROM orders")
def parallelism_control(t):
    cores = t.spark.sparkContext.defaultParallelism
    wide = partitioned.spread(t.orders, 2 * cores)
    narrow = partitioned.spread(wide, cores, coalesce=True)
    return narrow.select("o_orderkey", (F.spark_partition_id() < cores).alias("spread_ok"))


INCOMING = "SELECT c_custkey AS cust, c_nationkey AS nation, c_mktsegment AS segment FROM customer"
CURRENT = """SELECT DISTINCT concat('id-', cast(o_custkey AS STRING)) AS _id, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -o_custkey END AS cust FROM orders"""


def _doc_merge(t):
    return document.split_merge(t.sql(INCOMING), t.sql(CURRENT), ["cust"])


@query("g12_doc_merge_updates", f"SELECT _id, i.* FROM ({INCOMING}) i JOIN ({CURRENT}) c ON i.cust = c.cust")
def doc_merge_updates(t):
    return _doc_merge(t)[0]


@query("g12_doc_merge_inserts", f"SELECT * FROM ({INCOMING}) i WHERE cust NOT IN (SELECT cust FROM ({CURRENT}))")
def doc_merge_inserts(t):
    return _doc_merge(t)[1]


@query("g13_doc_overwrite", f"SELECT * FROM ({INCOMING})")
def doc_overwrite(t):
    """A collection that exists is emptied, then filled; the connector here is the file source."""
    path = t.scratch("collection")

    def truncate():
        t.spark.createDataFrame([], t.sql(INCOMING).schema).write.mode("overwrite").json(path)

    document.DocumentTarget({"path": path}, "json").write(t.sql(INCOMING))
    document.DocumentTarget({"path": path}, "json", "overwrite", exists=True, truncate=truncate).write(t.sql(INCOMING))
    return t.spark.read.schema(t.sql(INCOMING).schema).json(path)


@query(
    "g15_stream_body_sink",
    """SELECT CASE WHEN event_type = 'view' THEN to_json({'event_id': event_id, 'user_id': user_id})
                   ELSE to_json({'event_id': event_id, 'user_id': user_id, 'kind': event_type}) END::VARCHAR AS value,
              concat_ws('-', 'u', user_id) AS "partitionKey" FROM events""",
)
def stream_body_sink(t):
    rows = t.events.select("event_id", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"))
    path = t.scratch("messages")
    sent = messages.publish(messages.message_rows(rows, partition_key="concat_ws('-', 'u', user_id)"), "parquet", {"path": path})
    back = t.spark.read.parquet(path)
    return back.where(F.lit(sent) > 0).select("value", "partitionKey")


@query("g16_crm_upsert", "SELECT c_custkey, c_name FROM customer")
def crm_upsert(t):
    """Sent twice by its external id; each customer is there once."""
    path, rows = t.scratch("crm"), t.customer.select("c_custkey", "c_name")
    for name in (F.upper("c_name"), F.col("c_name")):
        _put(rows.withColumn("c_name", name), path, keys="c_custkey", batch=200)
    return staged.current(t.spark, path, ["c_custkey"])


def _files_sink(name: str, fmt: str) -> None:
    @query(name, "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
    def sink(t):
        path = t.scratch(f"sink-{fmt}")
        rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
        for status in ("F", "O", "P"):
            files.write_files(rows.where(F.col("o_orderstatus") == status), path, fmt, "append", ["o_orderstatus"])
        return t.spark.read.schema(rows.schema).format(fmt).load(path).select(*rows.columns)


for _fmt in ("parquet", "orc", "csv"):
    _files_sink(f"g19_files_sink_{_fmt}", _fmt)


@query(
    "g20_archive_processed",
    """SELECT DISTINCT '/in/' || o_orderstatus || '/f' || o_orderkey || '.csv' AS path,
              '/done/' || strftime(o_orderdate, '%Y%m%d') || '/' || o_custkey || '/f' || o_orderkey || '.csv' AS archived FROM orders""",
)
def archive_processed(t):
    listed = t.orders.select(
        F.concat(F.lit("/in/"), "o_orderstatus", F.lit("/f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"),
        F.col("o_orderdate").alias("processed_at"), F.col("o_custkey").alias("job_id"))
    return files.archive_plan(listed, "/done")


@query(
    "g20_archive_moves",
    "SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS lines, true AS moved, 0 AS left_behind FROM orders GROUP BY o_orderstatus",
)
def archive_moves(t):
    """Files of orders by status are moved below a done folder, twice: what has moved stays there."""
    base = t.scratch("archive")
    rows = t.orders.select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value"))
    rows.write.partitionBy("o_orderstatus").text(f"{base}/in")
    listed = list_files(t.spark, f"{base}/in", sub_folders=True).where(F.endswith("path", F.lit(".txt")))
    folder = F.element_at(F.split("path", "/"), -2)
    plan = files.archive_plan(listed.select("path", F.lit("2024-05-06").cast("date").alias("processed_at"), folder.alias("job_id")), f"{base}/done")
    plan = saved(plan, "archive-plan")
    for _ in range(2):
        moved = saved(files.archive(plan), "archive-moves")
    there = t.spark.read.option("recursiveFileLookup", True).text(f"{base}/done")
    lines = there.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder")).agg(F.count("*").alias("lines"))
    told = moved.groupBy(F.element_at(F.split("archived", "/"), -2).alias("folder")).agg(F.bool_and("moved").alias("moved"))
    left = list_files(t.spark, f"{base}/in", sub_folders=True).where(F.endswith("path", F.lit(".txt"))).agg(F.count("*").cast("int").alias("left_behind"))
    return lines.join(told, "folder").join(left).select("folder", "lines", "moved", "left_behind")


_EVENT_SPECS = [
    ColumnSpec("event_id", "bigint"), ColumnSpec("user", "bigint", "user_id"),
    ColumnSpec("at", "timestamp", "ts", mask="yyyy-MM-dd HH:mm:ss"), ColumnSpec("kind", "string", "event_type"),
]


def _event_files(t, repeats: int = 1):
    """The events as JSON lines in several files, as a feed would leave them."""
    path = t.scratch("feed")
    feed = t.events.select(
        "event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type"))
    if repeats > 1:
        feed = feed.select("*", F.explode(F.array_repeat(F.lit(0), repeats)).alias("_copy")).drop("_copy")
    feed.write.option("maxRecordsPerFile", 3000).json(path)
    return path


@query(
    "h1_stream_ingest",
    """SELECT event_id, user_id AS "user", CAST(date_trunc('second', ts) AS VARCHAR) AS at,
              CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind FROM events""",
)
def stream_ingest(t):
    lines = ingest.text_stream(t.spark, _event_files(t), files_per_trigger=2)
    out = t.scratch("typed")
    ingest.append_to_files(ingest.typed_records(lines, _EVENT_SPECS), out, t.scratch("cp")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user", F.col("at").cast("string").alias("at"), "kind")


@query(
    "h2_stream_upsert",
    """SELECT event_id, user_id AS "user", CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) = 1""",
)
def stream_upsert(t):
    lines = ingest.text_stream(t.spark, _event_files(t), files_per_trigger=2)
    log, order = t.scratch("log"), ["at", "event_id"]
    ingest.upsert_log(ingest.typed_records(lines, _EVENT_SPECS, None), log, t.scratch("cp"), ["user"], order).awaitTermination()
    return ingest.current_rows(t.spark, log, ["user"], order).select("event_id", "user", "kind")


@query(
    "h3_file_arrival_stream",
    """WITH d AS (SELECT o_orderpriority AS p, o_orderpriority IN ('1-URGENT', '2-HIGH') AS marked, count(*) FROM orders GROUP BY ALL)
       SELECT 'tab_' || left(p, 1) AS table_name, marked AS ready FROM d""",
)
def file_arrival_stream(t):
    """Data files per priority; a marker folder is there for two of them."""
    folder = t.scratch("landing")
    group = F.substring("o_orderpriority", 1, 1)
    rows = t.orders.select(F.concat(F.lit("g"), group).alias("g"), F.col("o_orderkey").cast("string").alias("value"))
    rows.hint("rebalance", "g").write.partitionBy("g").text(f"{folder}/data")
    arrived = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/data").select("path")
    done = arrived.where(F.col("path").rlike("g=g[12]")).select(
        F.replace(F.col("path"), F.lit(".txt"), F.lit(".done")).alias("path"), F.lit(None).cast("string").alias("table_name"))
    log, ready = t.scratch("arrivals"), t.scratch("ready")
    done.write.parquet(f"{log}/{ingest.BATCH}=-1")
    patterns = {f"tab_{i}": f"/g=g{i}/.*\\.txt$" for i in range(1, 6)}
    stream = ingest.arrivals(t.spark, f"{folder}/data", files_per_trigger=3)
    ingest.gate_arrivals(stream, log, ready, t.scratch("cp"), patterns, ".txt", ".done").awaitTermination()
    return ingest.latest_verdict(t.spark, ready).select("table_name", "ready")


@query(
    "h4_stream_body_publish",
    """SELECT to_json({'event_id': event_id, 'user': user_id})::VARCHAR AS value, CAST(user_id AS VARCHAR) AS "partitionKey" FROM events""",
)
def stream_body_publish(t):
    lines = ingest.text_stream(t.spark, _event_files(t))
    rows = ingest.typed_records(lines, _EVENT_SPECS, None).select("event_id", "user")
    out = t.scratch("published")
    ingest.publish_stream(rows, "parquet", {"path": out}, t.scratch("cp"), "user").awaitTermination()
    return t.spark.read.parquet(out).select("value", "partitionKey")


@query("h5_late_data_dedup", """SELECT event_id, user_id AS "user" FROM events""")
def late_data_dedup(t):
    lines = ingest.text_stream(t.spark, _event_files(t, repeats=3))
    rows = ingest.without_replays(ingest.typed_records(lines, _EVENT_SPECS, None), ["event_id"], "at", "1 hour")
    out = t.scratch("once")
    ingest.append_to_files(rows, out, t.scratch("cp")).awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user")
