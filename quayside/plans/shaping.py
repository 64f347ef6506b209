"""Schema conformance over the order, customer, event and line tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import schema as sc
from quayside.operators.schema import ColumnSpec
from quayside.plans.registry import query

ORDER_TEXTS = """
  SELECT cast(o_orderkey AS STRING) AS f_key,
         CASE WHEN o_orderpriority LIKE '4%' THEN concat('c', cast(o_custkey AS STRING))
              WHEN o_orderpriority LIKE '1%' THEN NULL
              ELSE cast(o_custkey AS STRING) END AS f_cust,
         cast(cast(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS f_price,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '2%' THEN '20220230'
              ELSE replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', '') END AS f_date,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE cast(o_orderdate AS STRING) END AS f_stamp,
         concat(o_orderpriority, '  ') AS f_priority,
         o_orderstatus AS f_status
  FROM orders"""

ORDER_SPECS = [
    ColumnSpec("order_key", "bigint", "f_key"),
    ColumnSpec("cust_key", "int", "f_cust"),
    ColumnSpec("price", "decimal(12,2)", "f_price"),
    ColumnSpec("order_date", "date", "f_date", mask="yyyymmdd"),
    ColumnSpec("order_stamp", "timestamp", "f_stamp"),
    ColumnSpec("status", "string", "f_status"),
]


@query(
    "b1_rename_map",
    "SELECT o_orderkey AS order_key, o_orderkey AS source_key, o_totalprice AS price FROM orders",
)
def rename_map(t):
    return sc.rename_map(t.orders, {"o_orderkey": ["order_key", "source_key"], "o_totalprice": "price"})


@query(
    "b2_typed_projection",
    f"""WITH raw AS ({ORDER_TEXTS}), typed AS (
          SELECT *, TRY_CAST(f_key AS BIGINT) AS order_key, TRY_CAST(f_cust AS INTEGER) AS cust_key,
                 CAST(TRY_CAST(f_price AS DECIMAL(12, 2)) AS DOUBLE) AS price,
                 CAST(try_strptime(f_date, '%Y%m%d') AS DATE) AS d,
                 try_strptime(f_stamp, '%Y-%m-%d %H:%M:%S') AS s
          FROM raw)
        SELECT order_key, cust_key, price, CAST(d AS VARCHAR) AS order_date,
               CAST(s AS VARCHAR) AS order_stamp, f_status AS status,
               concat_ws(',', CASE WHEN cust_key IS NULL AND f_cust <> '' THEN 'cust_key' END,
                              CASE WHEN d IS NULL AND f_date <> '' THEN 'order_date' END) AS rejects
        FROM typed""",
)
def typed_projection(t):
    shaped = sc.typed_projection(t.sql(ORDER_TEXTS), ORDER_SPECS, rejects="rejects")
    return shaped.select(
        "order_key", "cust_key", F.col("price").cast("double").alias("price"),
        F.col("order_date").cast("string").alias("order_date"),
        F.col("order_stamp").cast("string").alias("order_stamp"),
        "status", F.array_join("rejects", ",").alias("rejects"),
    )


@query(
    "b4_add_derived_columns",
    """SELECT o_orderkey, 7::INTEGER AS origin, CAST(2.5::FLOAT AS DOUBLE) AS factor,
              CAST(20240101::DECIMAL(38, 0) AS DOUBLE) AS batch, 'web' AS channel,
              true AS has_clock FROM orders""",
)
def add_derived_columns(t):
    made = sc.add_derived_columns(
        t.orders.select("o_orderkey"),
        {"origin": "7", "factor": "2.5", "batch": "||@LOAD_BATCH_ID||", "channel": "web",
         "d": "current_date", "ts": "current_timestamp", "tm": "CURRENT_TIME"},
        batch_id=20240101,
    )
    return made.select(
        "o_orderkey", "origin", F.col("factor").cast("double").alias("factor"),
        F.col("batch").cast("double").alias("batch"), "channel",
        (F.col("d").isNotNull() & F.col("ts").isNotNull() & F.col("tm").isNotNull()).alias("has_clock"),
    )


@query(
    "b5_add_missing_columns",
    """SELECT o_orderkey, o_orderstatus, '' AS note, 123::INTEGER AS lines, 123::BIGINT AS ref,
              123.45::DOUBLE AS fee, '9999-01-01 00:00:00' AS closed_at,
              o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) AS label, o_orderkey AS alias_key,
              true AS has_load_clock
       FROM orders""",
)
def add_missing_columns(t):
    target = (
        T.StructType()
        .add("o_orderkey", T.LongType()).add("o_orderstatus", T.StringType())
        .add("note", T.StringType()).add("lines", T.IntegerType()).add("ref", T.LongType())
        .add("fee", T.DoubleType()).add("closed_at", T.TimestampType()).add("label", T.StringType())
        .add("alias_key", T.LongType()).add("DW_LOAD_DT", T.DateType()).add("DW_LOAD_TM", T.StringType())
    )
    base = t.orders.select("o_orderkey", "o_orderstatus")
    full = sc.add_missing_columns(
        base, target, {"label": ":o_orderstatus||'-'||:o_orderkey", "alias_key": ":o_orderkey"})
    return full.select(
        "o_orderkey", "o_orderstatus", "note", "lines", "ref", "fee",
        F.col("closed_at").cast("string").alias("closed_at"), "label", "alias_key",
        (F.col("DW_LOAD_DT").isNotNull() & F.col("DW_LOAD_TM").rlike(":")).alias("has_load_clock"),
    )


@query(
    "b6_null_default_fill",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS p,
              CASE WHEN o_orderstatus = 'F' THEN 123::BIGINT ELSE o_custkey END AS c,
              CASE WHEN o_orderstatus = 'F' THEN 123.45 ELSE o_totalprice END AS amount,
              CASE WHEN o_orderstatus = 'F' THEN '1990-01-01 00:00:00'
                   ELSE CAST(o_orderdate AS VARCHAR) END AS ts,
              CASE WHEN o_orderstatus = 'F' THEN '1990-01-01'
                   ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d
       FROM orders""",
)
def null_default_fill(t):
    open_only = F.col("o_orderstatus") != "F"
    holes = t.orders.select(
        "o_orderkey",
        F.when(open_only, F.col("o_orderpriority")).alias("p"),
        F.when(open_only, F.col("o_custkey")).alias("c"),
        F.when(open_only, F.col("o_totalprice")).alias("amount"),
        F.when(open_only, F.col("o_orderdate")).alias("ts"),
        F.when(open_only, F.col("o_orderdate").cast("date")).alias("d"),
    )
    filled = sc.fill_null_defaults(holes)
    return filled.withColumns({"ts": F.col("ts").cast("string"), "d": F.col("d").cast("string")})


@query("b7_exclude_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def exclude_columns(t):
    return sc.keep_target_columns(t.orders, ["O_ORDERKEY", "O_CUSTKEY", "O_TOTALPRICE", "NOT_IN_FILE"])


@query("b8_drop_audit", "SELECT o_orderkey, o_totalprice FROM orders")
def drop_audit(t):
    scan = sc.add_audit(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"))
    return sc.drop_audit(scan, flagged=["O_ORDERSTATUS"])


@query(
    "b8_add_audit",
    """SELECT o_orderkey, 'orders.parquet' AS audit_file_name, false AS audit_is_deleted,
              true AS timed FROM orders""",
)
def add_audit(t):
    scan = sc.add_audit(t.orders.select("o_orderkey"))
    timed = F.col("audit_file_modified_at").isNotNull() & F.col("audit_loaded_at").isNotNull()
    return scan.select("o_orderkey", "audit_file_name", "audit_is_deleted", timed.alias("timed"))


@query(
    "b9_rtrim_strings",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS padded,
              o_orderstatus || ' ' AS kept FROM orders""",
)
def rtrim_strings(t):
    padded = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.concat("o_orderpriority", F.lit("   "))).alias("padded"),
        F.concat("o_orderstatus", F.lit(" ")).alias("kept"),
    )
    return sc.rtrim_strings(padded, transformed=["kept"])


@query("b10_uppercase_columns", "SELECT n_nationkey AS \"N_NATIONKEY\", n_name AS \"N_NAME\", c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def uppercase_columns(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    picked = joined.select("n_nationkey", "n_name", "c_custkey", "c_name")
    return sc.uppercase_columns(picked, only=["n_nationkey", "n_name", "C_NAME"])


@query(
    "b13_column_expression",
    """SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority,
              CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS bucket FROM orders""",
)
def column_expression(t):
    return sc.column_expressions(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
        {"bucket": "CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END",
         "o_orderpriority": "upper(o_orderpriority)"},
    ).drop("o_totalprice")


@query(
    "b14_json_struct_column",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_struct_column(t):
    return sc.json_struct_column(t.events, "props", "k int", into="parsed").select("event_id", "parsed.k")


@query(
    "b17_float_widening",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_discount AS FLOAT) AS VARCHAR) AS DOUBLE) AS discount,
              CAST(CAST(CAST(l_quantity AS FLOAT) AS VARCHAR) AS DOUBLE) AS quantity FROM lineitem""",
)
def float_widening(t):
    return sc.widen_floats(t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_discount").cast("float").alias("discount"),
        F.col("l_quantity").cast("float").alias("quantity"),
    ))


# A column catalog whose size grows with the part table: one table per part, its columns drawn
# from the attributes the part has. The same rows in SQL and, by exploding, as a DataFrame.
CATALOG = """
  SELECT concat('t', cast(p_partkey AS STRING)) AS table_name, col_name, target_name, position,
         source_code, target_code, is_audit
  FROM part JOIN (VALUES
    ('ID', 'id', 1, 3, -5, false), ('NAME', 'name', 2, 12, 12, false), ('PRICE', 'price', 3, 7, 8, false),
    ('MADE_ON', 'made_on', 4, 91, 91, false), ('SEEN_AT', 'seen_at', 5, 93, 93, false),
    ('SHAPE', 'shape', 6, 2002, 1111, false), ('FILE', 'audit_file', 7, 12, 12, true)
  ) AS c(col_name, target_name, position, source_code, target_code, is_audit)
  ON position <= 1 + p_size % 7 OR (p_type = 'ECONOMY' AND is_audit)"""


CATALOG_COLUMNS = """
  'ID', 'id', 1, 3, -5, false, 'NAME', 'name', 2, 12, 12, false, 'PRICE', 'price', 3, 7, 8, false,
  'MADE_ON', 'made_on', 4, 91, 91, false, 'SEEN_AT', 'seen_at', 5, 93, 93, false,
  'SHAPE', 'shape', 6, 2002, 1111, false, 'FILE', 'audit_file', 7, 12, 12, true"""


def column_catalog(t):
    rows = t.part.selectExpr(
        "concat('t', cast(p_partkey AS STRING)) AS table_name", "p_size", "p_type",
        f"stack(7, {CATALOG_COLUMNS}) AS (col_name, target_name, position, source_code, target_code, is_audit)",
    )
    return rows.where("position <= 1 + p_size % 7 OR (p_type = 'ECONOMY' AND is_audit)").drop("p_size", "p_type")


@query(
    "b18_schema_from_catalog_types",
    f"""WITH cat AS ({CATALOG}), named AS (
          SELECT *, CASE source_code WHEN -5 THEN 'BIGINT' WHEN 3 THEN 'DECIMAL' WHEN 12 THEN 'STRING'
                 WHEN 7 THEN 'FLOAT' WHEN 8 THEN 'DOUBLE' WHEN 91 THEN 'DATE' WHEN 93 THEN 'TIMESTAMP' ELSE 'Other' END AS st,
                 CASE target_code WHEN -5 THEN 'BIGINT' WHEN 3 THEN 'DECIMAL' WHEN 12 THEN 'STRING'
                 WHEN 7 THEN 'FLOAT' WHEN 8 THEN 'DOUBLE' WHEN 91 THEN 'DATE' WHEN 93 THEN 'TIMESTAMP' ELSE 'Other' END AS tt
          FROM cat)
        SELECT table_name,
               '{{' || string_agg('"' || target_name || '": "' || tt || '"', ', ' ORDER BY position) || '}}' AS target_columns,
               '{{' || coalesce(string_agg('"' || col_name || '": "' || st || '"', ', ' ORDER BY position)
                     FILTER (WHERE NOT is_audit), '') || '}}' AS source_columns
        FROM named GROUP BY table_name""",
)
def schema_from_catalog_types(t):
    return column_catalog(t).groupBy("table_name").agg(
        sc.columns_json("target_name", "target_code", "position").alias("target_columns"),
        sc.columns_json("col_name", "source_code", "position", where=~F.col("is_audit")).alias("source_columns"),
    )


@query(
    "b19_nested_path_get",
    """SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS VARCHAR), '') AS k,
              event_type AS first_tag, '' AS absent FROM events""",
)
def nested_path_get(t):
    wrapped = F.concat(F.lit('{"a": {"b": ['), F.col("props"), F.lit(', "'), F.col("event_type"), F.lit('"]}}'))
    return t.events.select(
        "event_id", sc.nested_path(wrapped, "a.b.0.k").alias("k"),
        sc.nested_path(wrapped, "a.b.1").alias("first_tag"), sc.nested_path(wrapped, "a.c.0").alias("absent"),
    )


@query(
    "b20_exclude_by_name_list",
    """WITH kept AS (
         SELECT c_name AS name, c_nationkey AS grp FROM customer
         WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))
       SELECT name, grp, CAST(floor(100.0 / count(*) OVER (PARTITION BY grp)) AS INTEGER) AS quota FROM kept""",
)
def exclude_by_name_list(t):
    configs = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("grp"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    listed = t.customer.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return sc.exclude_listed(configs, listed.select(F.col("c_name").alias("name")), "name", "grp").select(
        "name", "grp", "quota")


@query(
    "b21_epoch_to_temporal",
    """SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
              CAST(date_trunc('second', ts) AS VARCHAR) AS at FROM events""",
)
def epoch_to_temporal(t):
    seconds = t.events.select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s"))
    return seconds.select(
        "event_id", sc.epoch_to("s", "time").alias("clock"),
        sc.epoch_to("s", "date").cast("string").alias("d"),
        sc.epoch_to("s", "timestamp").cast("string").alias("at"),
    )


@query(
    "b22_target_schema_sync",
    """SELECT o_orderpriority, CAST(o_orderkey AS DOUBLE) AS "O_ORDERKEY", 'LOADER' AS "DW_LOAD_USER",
              CAST(NULL AS VARCHAR) AS remark, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS placed_on,
              true AS has_clock
       FROM orders""",
)
def target_schema_sync(t):
    target = (
        T.StructType().add("o_orderpriority", T.StringType()).add("O_ORDERKEY", T.DecimalType(20, 0))
        .add("DW_LOAD_USER", T.StringType()).add("DW_LOAD_DT", T.DateType())
        .add("DW_LOAD_TM", T.StringType()).add("DW_UPDT_TS", T.TimestampType())
        .add("remark", T.StringType()).add("placed_on", T.DateType())
    )
    source = t.orders.select(
        "o_orderkey", "o_orderpriority", "o_orderstatus",
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("placed_on"))
    synced = sc.sync_to_target(source, target, user="loader", epoch_types={"placed_on": "date"})
    clock = F.col("DW_LOAD_DT").isNotNull() & F.col("DW_LOAD_TM").isNotNull() & F.col("DW_UPDT_TS").isNotNull()
    return synced.select(
        "o_orderpriority", F.col("O_ORDERKEY").cast("double").alias("O_ORDERKEY"), "DW_LOAD_USER", "remark",
        F.col("placed_on").cast("string").alias("placed_on"), clock.alias("has_clock"),
    )
