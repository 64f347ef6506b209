"""Load strategy over control tables derived from parts and orders: one control row per part."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import strategy as st
from quayside.plans.registry import query

CONTROL = """
  SELECT p_partkey AS table_id, p_brand AS schema_name, p_name AS table_name,
         CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'ID' WHEN 2 THEN ' ID , NAME' ELSE NULL END AS natural_keys,
         CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN 'CREATE_DATE' WHEN 2 THEN 'LOADDATE, STARTDATE'
              WHEN 3 THEN 'it_update_date , UPDATEDATE,qty' WHEN 4 THEN 'qty' WHEN 5 THEN 'LOADDATE,UPDATE_DATE'
              ELSE NULL END AS split_candidates,
         p_type, p_size
  FROM part"""


def _strategy_sql(merge, append, pick):
    return f"""WITH c AS ({CONTROL}), m AS (
      SELECT *, list_filter(list_transform(string_split(coalesce(split_candidates, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS cand,
             len(list_filter(list_transform(string_split(coalesce(natural_keys, ''), ','), lambda x: trim(x)), lambda x: x <> '')) > 0 AS keyed
      FROM c), f AS (
      SELECT *, list_filter({merge}, lambda x: list_contains(cand, x)) AS mm,
             list_filter({append}, lambda x: list_contains(cand, x)) AS am FROM m)
    SELECT table_id,
      CASE WHEN keyed AND len(mm) > 0 THEN 'INCREMENTAL_MERGE' WHEN keyed AND len(am) > 0 THEN 'INCREMENTAL_APPEND'
           ELSE 'FULL_REFRESH' END AS strategy,
      CASE WHEN keyed AND len(mm) > 0 THEN {pick.format('mm')} WHEN keyed AND len(am) > 0 THEN {pick.format('am')}
           ELSE '' END AS watermark
    FROM f"""


_JOINED = _strategy_sql(st.MERGE_MARKS, st.APPEND_MARKS, "array_to_string({}, ',')")
_FIRST = _strategy_sql(st.MERGE_MARKS, st.APPEND_MARKS, "{}[1]")


@query("e1_choose_strategy", _JOINED)
def choose_strategy(t):
    return st.choose_strategy(t.sql(CONTROL)).select("table_id", "strategy", "watermark")


@query("e2_choose_watermark_first", _FIRST)
def choose_watermark_first(t):
    return st.choose_strategy(t.sql(CONTROL), first_only=True).select("table_id", "strategy", "watermark")


@query(
    "e3_probable_keys",
    f"""WITH c AS ({CONTROL}), k AS (
          SELECT table_id, natural_keys, ['cust_' || (CASE WHEN p_size > 25 THEN 'id' ELSE 'no' END), 'SALEKEY', 'NAME', 'nk_code', 'HIDDEN_ID'] AS cols FROM c)
        SELECT table_id, CASE WHEN trim(coalesce(natural_keys, '')) <> ''
             THEN array_to_string(list_transform(string_split(natural_keys, ','), lambda x: trim(x)), ',')
             ELSE array_to_string(list_filter(cols, lambda c: c <> 'HIDDEN_ID' AND (regexp_matches(lower(c), '(id|key)$') OR regexp_matches(c, '^nk_'))), ',') END AS keys
        FROM k""",
)
def probable_keys(t):
    first = F.concat(F.lit("cust_"), F.when(F.col("p_size") > 25, "id").otherwise("no"))
    rest = [F.lit(x) for x in ("SALEKEY", "NAME", "nk_code")]
    keys = st.probable_keys(
        F.array(first, *rest, F.lit("HIDDEN_ID")), "natural_keys", included=F.array(first, *rest), pattern="nk_")
    return t.sql(CONTROL).select("table_id", F.array_join(keys, ",").alias("keys"))


@query(
    "e4_default_control_row",
    """SELECT p_partkey AS table_id, 'orc' AS storage, 'False' AS scd, replace(p_name, ' ', '_') AS target_table,
              replace(p_brand, ' ', '_') AS target_schema, 'mine' AS watermark, 24::INTEGER AS n_columns FROM part""",
)
def default_control_row(t):
    tables = t.part.select(
        F.col("p_partkey").alias("table_id"), F.col("p_brand").alias("schema_name"),
        F.col("p_name").alias("table_name"), F.lit("mine").alias("watermark_column"))
    full = st.with_control_defaults(tables, "schema_name", "table_name", {
        "STORAGE_FORMAT": "orc", "TABLE_TYPE": "managed", "NOTE": ""})
    return full.select(
        "table_id", F.col("STORAGE_FORMAT").alias("storage"), F.col("SCD_TYPE_2").alias("scd"),
        F.col("TARGET_TABLE_NAME").alias("target_table"), F.col("TARGET_SCHEMA_NAME").alias("target_schema"),
        F.col("watermark_column").alias("watermark"), F.lit(len(full.columns) + 0).alias("n_columns"))


@query(
    "e5_user_overrides",
    f"""WITH d AS ({_JOINED}), u AS (
          SELECT p_partkey AS table_id, CASE WHEN p_size > 30 THEN 'FULL_REFRESH' WHEN p_size > 20 THEN ' ' END AS strategy,
                 CASE WHEN p_type = 'ECONOMY' THEN 'MY_MARK' ELSE '' END AS watermark FROM part WHERE p_size > 10)
        SELECT table_id, coalesce(nullif(trim(u.strategy), ''), d.strategy) AS strategy,
               coalesce(nullif(trim(u.watermark), ''), d.watermark) AS watermark
        FROM d LEFT JOIN u USING (table_id)""",
)
def user_overrides(t):
    derived = st.choose_strategy(t.sql(CONTROL)).select("table_id", "strategy", "watermark")
    user = t.part.where("p_size > 10").select(
        F.col("p_partkey").alias("table_id"),
        F.when(F.col("p_size") > 30, st.FULL).when(F.col("p_size") > 20, " ").alias("strategy"),
        F.when(F.col("p_type") == "ECONOMY", "MY_MARK").otherwise("").alias("watermark"))
    return st.with_user_overrides(derived, user, "table_id", ["strategy", "watermark"])


UPDATES = """
  SELECT o_orderkey AS loader_id,
         concat('order_id = :order_id', CASE WHEN o_orderstatus = 'F' THEN ' and  line_no=:line_no' ELSE '' END,
                CASE WHEN o_orderpriority LIKE '1%' THEN ' AND closed_at IS NULL' ELSE '' END) AS where_text
  FROM orders"""


@query(
    "e6_natural_keys_from_update",
    f"""WITH u AS ({UPDATES}) SELECT loader_id,
          array_to_string(list_transform(regexp_split_to_array(where_text, '(?i)\\s+AND\\s+'),
            lambda x: trim(regexp_split_to_array(x, '(?i)=|\\s+IS\\s+')[1])), ',') AS keys FROM u""",
)
def natural_keys_from_update(t):
    return t.sql(UPDATES).select("loader_id", F.array_join(st.keys_from_update("where_text"), ",").alias("keys"))


@query(
    "e7_dedupe_specs",
    """SELECT p_name AS table_name, max_by(p_brand, p_partkey) AS brand, max_by(p_size, p_partkey) AS size,
              max(p_partkey) AS seq FROM part GROUP BY p_name""",
)
def dedupe_specs(t):
    specs = t.part.select(
        F.col("p_name").alias("table_name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
        F.col("p_partkey").alias("seq"))
    return st.last_spec_per_table(specs, "table_name", "seq")


@query(
    "e8_inner_join_details",
    "SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON 'CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') = upper(c_name)",
)
def inner_join_details(t):
    loaders = t.orders.select("o_orderkey", F.concat(
        F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("table_name"))
    return st.join_details(loaders, t.customer, "table_name", "c_name").select("o_orderkey", "c_custkey", "c_mktsegment")


@query(
    "e9_publish_specs",
    """SELECT p_partkey AS table_id, 'out_' || p_name AS spec_name, p_brand AS target_schema, p_name AS target_table,
              'ID,' || p_type AS natural_keys, CASE WHEN p_size > 25 THEN 'full-load' ELSE 'incremental' END AS sync_type,
              'APPEND' AS update_strategy, 'UPDATED_AT' AS watermark_columns
       FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)
         AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.08)""",
)
def publish_specs(t):
    tables = t.part.select(
        F.col("p_partkey").alias("table_id"), F.col("p_name").alias("target_table"),
        F.col("p_brand").alias("target_schema"), F.array(F.lit("ID"), "p_type").alias("natural_keys"),
        F.when(F.col("p_size") > 25, "full-load").otherwise("incremental").alias("sync_type"),
        F.lit("append").alias("strategy"), F.array(F.lit("UPDATED_AT")).alias("watermarks"))
    ids = F.col("l_partkey").alias("table_id")
    return st.publish_specs(
        tables, "out_", include=t.lineitem.where("l_quantity > 45").select(ids),
        exclude=t.lineitem.where("l_returnflag = 'R' AND l_discount > 0.08").select(ids))


@query(
    "e10_build_mode",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'overwrite' WHEN o_orderstatus = 'O' THEN 'merge' ELSE 'append' END AS mode FROM orders",
)
def build_mode(t):
    specs = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "Full-Load").otherwise("incremental").alias("sync_type"),
        F.when(F.col("o_orderstatus") == "O", "MERGE").otherwise("APPEND").alias("update_strategy"))
    return specs.select("o_orderkey", st.build_mode().alias("mode"))


@query(
    "e11_group_members",
    """WITH m AS (SELECT o_orderpriority AS grp, o_custkey AS table_id,
                         max(CASE WHEN o_totalprice > 400000 THEN 7 ELSE 0 END) AS ov FROM orders GROUP BY 1, 2)
       SELECT grp, table_id, count(*) OVER (PARTITION BY grp) AS n_tables,
              CAST(coalesce(nullif(ov, 0), floor(100.0 / count(*) OVER (PARTITION BY grp))) AS INTEGER) AS quota FROM m""",
)
def group_members(t):
    members = t.orders.select(
        F.col("o_orderpriority").alias("grp"), F.col("o_custkey").alias("table_id"),
        F.when(F.col("o_totalprice") > 400000, 7).otherwise(0).alias("override"))
    return st.group_quota(members, "grp", "table_id", "override")
