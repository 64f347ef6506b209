"""Metadata reports: events stand for job runs, orders and lines for jobs and their tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import lineage, metrics
from quayside.plans.registry import query
from quayside.plans.shaping import CATALOG, column_catalog

# A job per event and a table per user. Purchases and clicks leave a capture and a merge row,
# the others a single one; errors failed.
METRICS = """
  SELECT event_id AS job_id, user_id AS table_id, 1 AS seq,
         CASE WHEN event_type = 'view' THEN 'FULL' ELSE 'CDC' END AS job_type,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS job_status,
         concat('s', cast(user_id % 7 AS STRING)) AS source_schema_name, 'db' AS source_database_name,
         cast(floor(value) AS BIGINT) AS fetch_records_count,
         CASE WHEN event_type = 'signup' THEN NULL ELSE event_id * 3 END AS target_records_count,
         cast(NULL AS STRING) AS first_merged_watermark, cast(NULL AS STRING) AS last_merged_watermark,
         cast(NULL AS STRING) AS workflow_id, 'run' AS workflow_run_id
  FROM events
  UNION ALL
  SELECT event_id, user_id, 2, 'MERGE', 'SUCCESS', cast(NULL AS STRING), cast(NULL AS STRING), 0, event_id * 5,
         substr(cast(ts AS STRING), 1, 10), substr(cast(ts AS STRING), 1, 13), concat('w', cast(user_id AS STRING)), 'run2'
  FROM events WHERE event_type IN ('purchase', 'click')"""

FACTS = f"""WITH m AS ({METRICS}), f AS (
    SELECT a.job_id, a.table_id, b.job_id IS NOT NULL AS several, a.job_type AS jt,
           a.fetch_records_count, a.source_schema_name, a.source_database_name,
           CASE WHEN b.job_id IS NULL THEN a.job_status ELSE b.job_status END AS job_status,
           CASE WHEN b.job_id IS NULL THEN a.target_records_count ELSE b.target_records_count END AS target_records_count,
           b.first_merged_watermark, b.last_merged_watermark, b.workflow_id,
           CASE WHEN b.job_id IS NULL THEN a.workflow_run_id ELSE b.workflow_run_id END AS workflow_run_id
    FROM (SELECT * FROM m WHERE seq = 1) a LEFT JOIN (SELECT * FROM m WHERE seq = 2) b
         ON a.job_id = b.job_id AND a.table_id = b.table_id)
  SELECT job_id, table_id, CASE WHEN several OR jt = 'CDC' THEN 'INCREMENTAL' ELSE jt END AS job_type,
         fetch_records_count, source_schema_name, source_database_name, job_status, target_records_count,
         first_merged_watermark, last_merged_watermark, workflow_id, workflow_run_id,
         CASE WHEN job_status = 'FAILED' THEN target_records_count ELSE target_records_count - fetch_records_count END AS pre_target_count
  FROM f"""


@query("i1_job_metrics_fact", FACTS)
def job_metrics_fact(t):
    return metrics.job_metrics_fact(t.sql(METRICS), ["seq"])


@query(
    "i2_pre_target_count",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN event_id * 3
              ELSE event_id * 3 - user_id END AS pre_target_count FROM events""",
)
def pre_target_count(t):
    rows = t.events.select(
        "event_id", F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("job_status"),
        F.when(F.col("event_type") != "signup", F.col("event_id") * 3).alias("target_records_count"),
        F.col("user_id").alias("number_of_records_written"))
    return rows.select("event_id", metrics.pre_target_count(moved="number_of_records_written").alias("pre_target_count"))


@query(
    "i3_fallback_metrics",
    f"""WITH facts AS ({FACTS.replace('FROM f', "FROM f WHERE job_status <> 'FAILED'")}),
        jobs AS (SELECT event_id AS job_id, user_id AS table_id, CASE WHEN value > 15 THEN 'export_data' ELSE 'source_crawl' END AS job_kind FROM events),
        tabs AS (SELECT c_custkey AS table_id, CAST(c_nationkey AS BIGINT) * 100 AS row_count, lower(c_mktsegment) AS sync_type FROM customer)
        SELECT j.job_id, j.table_id,
          CASE WHEN f.job_id IS NULL THEN CASE WHEN job_kind = 'export_data' THEN 'EXPORT' ELSE upper(sync_type) END ELSE f.job_type END AS job_type,
          coalesce(fetch_records_count, 0) AS fetch_records_count,
          CASE WHEN f.job_id IS NULL THEN row_count ELSE pre_target_count END AS pre_target_count,
          CASE WHEN f.job_id IS NULL THEN row_count ELSE target_records_count END AS target_records_count
        FROM jobs j LEFT JOIN facts f ON f.job_id = j.job_id AND f.table_id = j.table_id LEFT JOIN tabs t ON t.table_id = j.table_id""",
)
def fallback_metrics(t):
    facts = metrics.job_metrics_fact(t.sql(METRICS), ["seq"]).where("job_status <> 'FAILED'")
    jobs = t.events.select(
        F.col("event_id").alias("job_id"), F.col("user_id").alias("table_id"),
        F.when(F.col("value") > 15, "export_data").otherwise("source_crawl").alias("job_kind"))
    tables = t.customer.select(
        F.col("c_custkey").alias("table_id"), (F.col("c_nationkey").cast("long") * 100).alias("row_count"),
        F.lower("c_mktsegment").alias("sync_type"))
    return metrics.with_fallback(jobs, facts, tables)




def _header_sql(source: str, **given: str) -> str:
    cells = ", ".join(f"{given.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in metrics.JOB_REPORT)
    return f"SELECT {cells} FROM {source}"


@query(
    "i4_union_job_kinds",
    " UNION ALL ".join([
        _header_sql("events", job_id="event_id", entity_type="'source'", job_status="event_type", fetch_records_count="user_id"),
        _header_sql("orders", job_id="o_orderkey", entity_type="'flow'", job_status="o_orderstatus",
                    target_table_name="o_orderpriority", fetch_records_count="NULL"),
        _header_sql("customer", job_id="c_custkey", entity_type="'workflow'", workflow_id="c_name", fetch_records_count="NULL"),
    ]),
)
def union_job_kinds(t):
    ingest = t.events.select(
        F.col("event_id").alias("job_id"), F.lit("source").alias("entity_type"),
        F.col("event_type").alias("job_status"), F.col("user_id").alias("fetch_records_count"), "ts")
    flow = t.orders.select(
        F.col("o_orderkey").alias("job_id"), F.lit("flow").alias("entity_type"),
        F.col("o_orderstatus").alias("job_status"), F.col("o_orderpriority").alias("target_table_name"))
    workflow = t.customer.select(
        F.col("c_custkey").alias("job_id"), F.lit("workflow").alias("entity_type"), F.col("c_name").alias("workflow_id"))
    return metrics.job_report(ingest, flow, workflow)


@query(
    "i5_recent_jobs",
    """SELECT event_id, event_type AS job_type FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-08 12:00:00' - INTERVAL 720 MINUTE AND TIMESTAMP '2024-01-08 12:00:00'
         AND event_type IN ('click', 'view') AND user_id < 700""",
)
def recent_jobs(t):
    jobs = t.events.select(
        "event_id", F.col("ts").alias("updated_at"), F.col("event_type").alias("job_type"),
        F.when(F.col("user_id") < 700, "completed").otherwise("failed").alias("job_status"))
    recent = metrics.recent_jobs(jobs, "2024-01-08 12:00:00", 720, ["click", "view"], ["completed"])
    return recent.select("event_id", "job_type")


@query(
    "i6_job_user_join",
    """SELECT event_id, user_id AS created_by, c_name AS creator_name, c_name || '@x.org' AS creator_email
       FROM events LEFT JOIN customer ON CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey ELSE c_custkey END = user_id""",
)
def job_user_join(t):
    users = t.customer.select(
        F.when(F.col("c_mktsegment") == "BUILDING", -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("id"),
        F.struct(F.concat("c_name", F.lit("@x.org")).alias("email"), F.col("c_name").alias("name")).alias("profile"))
    return metrics.with_creator(t.events.select("event_id", F.col("user_id").alias("created_by")), users)


@query(
    "i7_job_link",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN 'https://host:443/job/logs?jobId=' || event_id END AS job_link FROM events""",
)
def job_link(t):
    jobs = t.events.withColumn("job_id", F.when(F.col("event_type") != "view", F.col("event_id")))
    return jobs.select("event_id", metrics.job_link("https", "host", 443).alias("job_link"))


@query(
    "i8_target_name_by_type",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || '.ds' ELSE 'sch.' || CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'db' END END AS name FROM orders""",
)
def target_name_by_type(t):
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "bigquery").otherwise("SNOWFLAKE").alias("target_type"),
        F.col("o_orderpriority").alias("project_id"), F.lit("ds").alias("dataset_name"), F.lit("sch").alias("schema_name"),
        F.when(F.col("o_orderstatus") != "O", "db").alias("database_name"))
    return rows.select("o_orderkey", metrics.target_name().alias("name"))


@query(
    "i9_usage_rollup",
    """WITH u AS (SELECT DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE -l_partkey END AS item_id, l_suppkey AS user_id FROM lineitem),
            n AS (SELECT CASE WHEN s_acctbal > 1000 THEN s_suppkey ELSE -s_suppkey END AS s_suppkey, s_name FROM supplier)
       SELECT p_partkey AS item_id, CASE WHEN p_type = 'ECONOMY' THEN CAST(p_partkey AS VARCHAR) ELSE p_name END AS item_name,
              CASE WHEN user_id IS NOT NULL THEN coalesce(s_name, 'deleted_user') END AS user_name
       FROM part LEFT JOIN u ON item_id = p_partkey LEFT JOIN n ON s_suppkey = user_id""",
)
def usage_rollup(t):
    items = t.part.select(
        F.col("p_partkey").alias("item_id"), F.when(F.col("p_type") != "ECONOMY", F.col("p_name")).alias("item_name"))
    def shifted(keeps, key):
        return F.when(F.expr(keeps), F.col(key)).otherwise(-F.col(key))

    usage = t.lineitem.select(shifted("l_returnflag = 'R'", "l_partkey").alias("item_id"), F.col("l_suppkey").alias("user_id"))
    users = t.supplier.select(shifted("s_acctbal > 1000", "s_suppkey").alias("user_id"), F.col("s_name").alias("user_name"))
    return metrics.usage_pairs(items, usage, users)


CONNECTIONS = """
  SELECT concat('src', cast(event_id AS STRING)) AS source_name, event_type,
         concat('{"conn": {"auth": {"secret_id": "s', cast(user_id AS STRING), '"}, "p": ', props, '}, "secret_id" : "x',
                cast(user_id AS STRING), '"}') AS connection FROM events WHERE event_type <> 'view'
  UNION ALL
  SELECT concat('src', cast(event_id AS STRING)), event_type, props FROM events WHERE event_type = 'view'"""


@query(
    "i10_secret_usage",
    f"""WITH c AS ({CONNECTIONS}), e AS (
          SELECT source_name, event_type, unnest(regexp_extract_all(connection, '"secret_id"\\s*:\\s*"([^"]*)"', 1)) AS secret FROM c)
        SELECT DISTINCT unnest([event_type, 'all']) AS domain, secret, source_name FROM e""",
)
def secret_usage(t):
    sources = t.sql(CONNECTIONS).withColumn("domains", F.array("event_type", F.lit("all")))
    return metrics.secret_usage(sources)


@query(
    "i11_latest_run_per_workflow",
    """SELECT user_id AS workflow_id, max_by(event_id, struct_pack(a := ts, b := event_id)) AS run_id, CAST(max(ts) AS VARCHAR) AS created_at
       FROM events GROUP BY user_id""",
)
def latest_run(t):
    runs = t.events.select(F.col("user_id").alias("workflow_id"), F.col("event_id").alias("run_id"), F.col("ts").alias("created_at"))
    return metrics.latest_run(runs).withColumn("created_at", F.col("created_at").cast("string"))


COMMANDS = """
  SELECT o_orderkey AS workflow_id,
         concat('cd /tmp && python /opt/ext/', o_orderstatus, '/load_', cast(o_custkey AS STRING), '.py --day 3 ; sh /opt/ext/',
                substr(o_orderpriority, 1, 1), '/done.sh ', CASE WHEN o_orderstatus = 'F' THEN '/opt/other/x.py' ELSE '' END) AS command
  FROM orders"""
_EXT = r"/opt/ext/[^/\s]*/\S*\.\w+"


@query(
    "i12_regex_reference_extract",
    f"""WITH c AS ({COMMANDS})
        SELECT DISTINCT unnest(regexp_extract_all(command, '{_EXT}')) AS path, workflow_id FROM c""",
)
def regex_reference_extract(t):
    return metrics.references(t.sql(COMMANDS), "command", _EXT, "workflow_id")


_TABLES = """
  SELECT concat('t', cast(p_partkey AS STRING)) AS table_id, p_brand AS source_schema_name, p_name AS source_table_name,
         CASE WHEN p_size > 25 THEN '.*csv' END AS include_regex, CASE WHEN p_size > 40 THEN '.*bkp' END AS exclude_regex,
         CASE WHEN p_type = 'SMALL' THEN 'bigquery' WHEN p_type = 'LARGE' THEN '' END AS export_type,
         'edb' AS export_database, 'esch' AS export_schema, 'etab' AS export_table, 'snowflake' AS environment_type,
         'tsch' AS target_schema_name, concat('tt', cast(p_partkey AS STRING)) AS target_table_name, p_size
  FROM part"""
_NAMES = "CASE {} WHEN -5 THEN 'BIGINT' WHEN 3 THEN 'DECIMAL' WHEN 12 THEN 'STRING' WHEN 7 THEN 'FLOAT' WHEN 8 THEN 'DOUBLE' WHEN 91 THEN 'DATE' WHEN 93 THEN 'TIMESTAMP' ELSE 'Other' END"
_DESCRIBED = f"""cat AS ({CATALOG}), des AS (
  SELECT table_name AS table_id,
    '{{' || string_agg('"' || target_name || '": "' || {_NAMES.format('target_code')} || '"', ', ' ORDER BY position) || '}}' AS target_columns_and_datatypes,
    '{{' || coalesce(string_agg('"' || col_name || '": "' || {_NAMES.format('source_code')} || '"', ', ' ORDER BY position) FILTER (WHERE NOT is_audit), '') || '}}' AS source_columns_and_datatypes
  FROM cat WHERE table_name NOT LIKE '%7' GROUP BY table_name)"""


def _table_report(t):
    columns = column_catalog(t).where("table_name NOT LIKE '%7'").select(
        F.col("table_name").alias("table_id"), F.col("col_name").alias("original_name"), "target_name",
        "source_code", "target_code", "position", "is_audit")
    return metrics.table_report(t.sql(_TABLES), columns)


@query(
    "i13_table_metadata_report",
    f"""WITH tabs AS ({_TABLES}), {_DESCRIBED}
        SELECT table_id, source_schema_name, source_table_name,
          CASE WHEN include_regex IS NOT NULL OR exclude_regex IS NOT NULL
               THEN 'Include Regex: ' || coalesce(include_regex, 'None') || ', Exclude Regex: ' || coalesce(exclude_regex, 'None') END AS source_file_pattern,
          CASE WHEN export_type <> '' THEN upper(export_type) ELSE 'SNOWFLAKE (INGESTION)' END AS target_type,
          CASE WHEN export_type <> '' THEN export_database ELSE '' END AS target_database_name,
          CASE WHEN export_type <> '' THEN export_schema ELSE target_schema_name END AS target_schema_name,
          CASE WHEN export_type <> '' THEN export_table ELSE target_table_name END AS target_table_name,
          target_columns_and_datatypes, source_columns_and_datatypes
        FROM tabs JOIN des USING (table_id)""",
)
def table_metadata_report(t):
    return _table_report(t)[0]


@query(
    "i13_table_metadata_failures",
    f"""WITH tabs AS ({_TABLES}) SELECT table_id, source_table_name, 'no columns' AS error_message FROM tabs WHERE table_id LIKE '%7'""",
)
def table_metadata_failures(t):
    return _table_report(t)[1]


@query(
    "i14_flow_metadata_report",
    """SELECT o_orderkey AS flow_id, 'n2' AS node, CASE WHEN o_orderstatus = 'F' THEN 'BIGQUERY_TARGET' ELSE 'TARGET' END AS target_type,
              CASE WHEN o_orderstatus = 'F' THEN 'tsch' ELSE 'sch' END AS target_schema_name,
              CASE WHEN o_orderstatus = 'F' THEN 'ds' ELSE 'db' END AS target_database_name,
              'tab_' || o_custkey AS target_table_name, 'id,' || o_orderpriority AS natural_keys, 'merge' AS build_mode,
              'id:int,amount:double' AS columns
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def flow_metadata_report(t):
    finished = F.col("o_orderstatus") == "F"
    props = F.create_map(
        F.lit("schema_name"), F.lit("sch"), F.lit("target_schema_name"), F.when(finished, "tsch"),
        F.lit("dataset_name"), F.lit("ds"), F.lit("database_name"), F.lit("db"),
        F.lit("table_name"), F.concat(F.lit("tab_"), F.col("o_custkey").cast("string")), F.lit("sync_type"), F.lit("merge"))
    outputs = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(d).alias("data_type"))
        for n, d in (("id", "int"), ("Audit_file", "string"), ("amount", "double"))])

    def node(kind):
        return F.struct(
            kind.alias("type"), props.alias("properties"),
            F.array(F.lit("id"), F.col("o_orderpriority")).alias("natural_keys"), outputs.alias("output_columns"))

    kind = F.when(finished, "bigquery_target").when(F.col("o_orderstatus") == "O", "target").otherwise("filter")
    flows = t.orders.select(
        F.col("o_orderkey").alias("flow_id"),
        F.create_map(F.lit("n1"), node(F.lit("source_table")), F.lit("n2"), node(kind)).alias("nodes"))
    return metrics.flow_targets(flows)


LINEAGE_COLUMNS = """
  SELECT concat('t', cast(l_orderkey AS STRING)) AS target_table, 'mart' AS target_schema,
         CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 'AUDIT_ID' ELSE concat('c', cast(l_linenumber AS STRING)) END AS target_column,
         'lake' AS source_schema, concat('p', cast(l_partkey AS STRING)) AS source_table, concat('s', cast(l_suppkey AS STRING)) AS source_column,
         CASE WHEN l_returnflag = 'R' THEN 'DERIVE' ELSE 'source_table' END AS node_type,
         concat('x * ', cast(l_linenumber AS STRING)) AS expression
  FROM lineitem"""


@query(
    "i15_column_lineage_edges",
    f"""WITH c AS ({LINEAGE_COLUMNS})
        SELECT CASE WHEN node_type = 'source_table' THEN source_schema || '.' || source_table || '.' || source_column END AS src,
               target_schema || '.' || target_table || '.' || target_column AS trg,
               CASE WHEN node_type <> 'source_table' THEN node_type || ':' || expression END AS derived_by
        FROM c WHERE target_column <> 'AUDIT_ID'""",
)
def column_lineage_edges(t):
    return lineage.column_edges(t.sql(LINEAGE_COLUMNS))


# Orders read customers, customers read older customers and nations, nations read regions, and
# regions read nations again: chains, joins of paths, cycles, and an edge to itself.
FLOW_EDGES = """
  SELECT concat('o', cast(o_orderkey AS STRING)) AS trg, concat('c', cast(o_custkey AS STRING)) AS src FROM orders
  UNION ALL SELECT concat('c', cast(c_custkey AS STRING)), concat('c', cast(cast(floor(c_custkey / 10) AS BIGINT) AS STRING)) FROM customer
  UNION ALL SELECT concat('c', cast(c_custkey AS STRING)), concat('n', cast(c_nationkey AS STRING)) FROM customer
  UNION ALL SELECT concat('n', cast(n_nationkey AS STRING)), concat('r', cast(n_regionkey AS STRING)) FROM nation
  UNION ALL SELECT concat('r', cast(n_regionkey AS STRING)), concat('n', cast(n_nationkey AS STRING)) FROM nation"""
FLOW_STARTS = "SELECT concat('o', cast(o_orderkey AS STRING)) AS node FROM orders WHERE o_orderpriority = '1-URGENT'"


@query(
    "i16_lineage_closure",
    f"""WITH RECURSIVE e AS ({FLOW_EDGES}), up(node) AS (
          {FLOW_STARTS} UNION SELECT e.src FROM up JOIN e ON e.trg = up.node)
        SELECT node FROM up""",
)
def lineage_closure(t):
    return lineage.upstream(t.sql(FLOW_EDGES), t.sql(FLOW_STARTS)).select("node")


PATHS = """
  SELECT l_returnflag AS system, concat('d', cast(l_suppkey AS STRING)) AS database,
         concat('t', cast(l_orderkey AS STRING)) AS "table", concat('c', cast(l_linenumber AS STRING)) AS "column"
  FROM lineitem"""


@query(
    "i17_lineage_tree",
    f"""WITH p AS (SELECT DISTINCT * FROM ({PATHS})), tb AS (SELECT system, database, "table", count(*) AS n FROM p GROUP BY ALL),
          db AS (SELECT system, database, count(*) AS n FROM tb GROUP BY ALL), sy AS (SELECT system, count(*) AS n FROM db GROUP BY ALL)
        SELECT 'column' AS kind, "column" AS name, concat_ws('/', system, database, "table", "column") AS path,
               concat_ws('/', system, database, "table") AS parent, 0::BIGINT AS children FROM p
        UNION ALL SELECT 'table', "table", concat_ws('/', system, database, "table"), concat_ws('/', system, database), n FROM tb
        UNION ALL SELECT 'database', database, concat_ws('/', system, database), system, n FROM db
        UNION ALL SELECT 'system', system, system, NULL, n FROM sy""",
)
def lineage_tree(t):
    return lineage.tree_nodes(t.sql(PATHS.replace('"', "`")))


@query(
    "i18_lineage_fqdn",
    """SELECT o_orderkey, concat_ws('.', CASE WHEN o_orderstatus = 'F' THEN 'cat' END, o_orderstatus, o_orderpriority, 'id') AS fqdn FROM orders""",
)
def lineage_fqdn(t):
    catalog = F.when(F.col("o_orderstatus") == "F", "cat")
    return t.orders.select("o_orderkey", lineage.fqdn("o_orderstatus", "o_orderpriority", F.lit("id"), catalog=catalog).alias("fqdn"))


@query(
    "i20_ingestion_metrics_concat",
    """SELECT o_orderkey AS id, 'orders' AS tab, o_totalprice AS amount, NULL AS note FROM orders
       UNION ALL SELECT c_custkey, 'customer', NULL, c_mktsegment FROM customer
       UNION ALL SELECT s_suppkey, 'supplier', s_acctbal, NULL FROM supplier""",
)
def ingestion_metrics_concat(t):
    return metrics.united_metrics([
        t.orders.select(F.col("o_orderkey").alias("id"), F.lit("orders").alias("tab"), F.col("o_totalprice").alias("amount")),
        t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("tab"), F.col("c_mktsegment").alias("note")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("tab"), F.col("s_acctbal").alias("amount")),
    ]).select("id", "tab", "amount", "note")


@query(
    "i21_artifact_owners",
    """WITH a AS (
         SELECT p_name AS name, CAST(p_size AS BIGINT) AS created_by, CAST(NULL AS BIGINT) AS modified_by, 'source' AS artifact_type FROM part
         UNION ALL SELECT o_orderpriority, o_custkey, o_orderkey, 'flow' FROM orders
         UNION ALL SELECT event_type, user_id, event_id, 'workflow' FROM events)
       SELECT artifact_type, name, created_by, modified_by, coalesce(u.s_name, 'deleted_user') AS created_by_name,
              coalesce(v.s_name, 'deleted_user') AS modified_by_name
       FROM a LEFT JOIN supplier u ON u.s_suppkey = created_by LEFT JOIN supplier v ON v.s_suppkey = modified_by""",
)
def artifact_owners(t):
    users = t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("user_name"))
    owners = metrics.artifact_owners(users, {
        "source": t.part.select(F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("created_by")),
        "flow": t.orders.select(F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("created_by"), F.col("o_orderkey").alias("modified_by")),
        "workflow": t.events.select(F.col("event_type").alias("name"), F.col("user_id").alias("created_by"), F.col("event_id").alias("modified_by")),
    })
    return owners.select("artifact_type", "name", "created_by", "modified_by", "created_by_name", "modified_by_name")
