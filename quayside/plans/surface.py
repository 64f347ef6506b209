"""One query per SQL construct users of the replaced scripts rely on."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators import relational as rel
from quayside.plans.registry import add, query


def _both(name: str, text: str, duck: str | None = None) -> None:
    """A construct that is plain SQL; ``duck`` where the check needs other words."""
    add(name, lambda t: t.sql(text), duck or text)


_both("k1_projection_distinct", "SELECT DISTINCT o_orderstatus AS s, o_orderpriority FROM orders")
_both("k1_projection_star",
      "SELECT n.*, c.c_custkey AS cust, c.c_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")

_both(
    "k2_where_predicates",
    """SELECT o_orderkey FROM orders
       WHERE (o_totalprice BETWEEN 100000 AND 300000 OR NOT o_orderpriority LIKE '%LOW')
         AND o_orderstatus IN ('F', 'O') AND o_orderdate IS NOT NULL AND o_orderkey <> 17
         AND o_orderpriority RLIKE '^[1-4]-' AND nullif(o_orderstatus, 'F') <=> NULL""",
    """SELECT o_orderkey FROM orders
       WHERE (o_totalprice BETWEEN 100000 AND 300000 OR NOT o_orderpriority LIKE '%LOW')
         AND o_orderstatus IN ('F', 'O') AND o_orderdate IS NOT NULL AND o_orderkey <> 17
         AND regexp_matches(o_orderpriority, '^[1-4]-') AND nullif(o_orderstatus, 'F') IS NOT DISTINCT FROM NULL""",
)
_both(
    "k2_where_subqueries",
    """SELECT c_custkey, c_name FROM customer c
       WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)
         AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
         AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""",
)

# Whole tables; shifted keys are those that find no partner.
_L = "SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -o_orderkey ELSE o_orderkey END AS k, o_custkey FROM orders"
_R = "SELECT CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE l_orderkey + 10000000000 END AS k, l_linenumber, l_quantity FROM lineitem"
for _name, _join in (
    ("inner", "JOIN r ON l.k = r.k"),
    ("left_outer", "LEFT OUTER JOIN r ON l.k = r.k"),
    ("right_outer", "RIGHT OUTER JOIN r ON l.k = r.k"),
    ("full_outer", "FULL OUTER JOIN r ON l.k = r.k"),
):
    _both(f"k3_join_{_name}",
          f"WITH l AS ({_L}), r AS ({_R}) SELECT l.k AS lk, o_custkey, r.k AS rk, l_linenumber, l_quantity FROM l {_join}")
for _name, _kind in (("left_semi", "SEMI"), ("left_anti", "ANTI")):
    _both(f"k3_join_{_name}", f"WITH l AS ({_L}), r AS ({_R}) SELECT l.k, o_custkey FROM l LEFT {_kind} JOIN r ON l.k = r.k",
          f"WITH l AS ({_L}), r AS ({_R}) SELECT l.k, o_custkey FROM l {_kind} JOIN r ON l.k = r.k")
_both("k3_join_natural", f"WITH l AS ({_L}), r AS ({_R}) SELECT k, o_custkey, l_linenumber FROM l NATURAL JOIN r")
_both("k3_join_using", f"WITH l AS ({_L}), r AS ({_R}) SELECT k, o_custkey, l_linenumber FROM l JOIN r USING (k)")
_both(
    "k3_join_theta",
    """SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem
       ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate AND (l_extendedprice < o_totalprice / 4 OR l_quantity > 40)""",
)

_both(
    "k4_group_having",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
              CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS numbers,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price,
              count(ALL l_tax) AS taxes
       FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10""",
)
for _name, _by in (
    ("rollup", "ROLLUP (l_returnflag, l_linestatus)"),
    ("cube", "CUBE (l_returnflag, l_linestatus, l_linenumber)"),
    ("grouping_sets", "GROUPING SETS ((l_returnflag, l_linenumber), (l_linestatus), ())"),
):
    _keys = "l_returnflag, l_linestatus" + ("" if _name == "rollup" else ", l_linenumber")
    _grouped = "grouping(l_returnflag)"
    _both(f"k4_{_name}",
          f"""SELECT {_keys}, CAST({_grouped} AS INT) AS g, count(*) AS n,
                     CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY {_by}""")


@query(
    "k5_window_running_total",
    """SELECT event_id, user_id, CAST(CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18, 2)) AS DOUBLE) AS total FROM events""",
)
def running_total(t):
    exact = t.events.withColumn("amount", F.col("value").cast("decimal(18,2)"))
    hours = F.date_trunc("hour", "ts")
    total = rel.running_total(exact, ["user_id"], ["ts", "event_id"], "amount", hours, "total")
    return total.select("event_id", "user_id", F.col("total").cast("decimal(18,2)").cast("double").alias("total"))


@query(
    "k5_window_range_lookback",
    """SELECT event_id, CAST(CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER w AS DECIMAL(18, 2)) AS DOUBLE) AS recent
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW)""",
)
def range_lookback(t):
    exact = t.events.withColumn("amount", F.col("value").cast("decimal(18,2)"))
    recent = rel.lookback_sum(exact, ["user_id"], "ts", "amount", 6 * 3600, "recent")
    return recent.select("event_id", F.col("recent").cast("decimal(18,2)").cast("double").alias("recent"))


@query(
    "k5_window_rank",
    """SELECT o_orderkey, o_orderstatus, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) AS place FROM orders""",
)
def window_rank(t):
    ranked = rel.rank_within(t.orders, ["o_orderstatus"], "o_orderdate", F.date_trunc("day", "o_orderdate"), "place")
    return ranked.select("o_orderkey", "o_orderstatus", "place")


_both(
    "k5_window_named",
    """SELECT l_orderkey, l_linenumber, l_partkey, lag(l_linenumber) OVER w AS prev, count(*) OVER w AS so_far
       FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_shipdate, l_extendedprice)""",
)


@query(
    "k6_qualify",
    """SELECT o_orderkey, o_custkey FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""",
)
def qualify(t):
    best = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return rel.qualify(t.orders, "place <= 2", place=F.row_number().over(best)).select("o_orderkey", "o_custkey")


_both(
    "k7_order_limit",
    """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, o_totalprice FROM orders
       ORDER BY p DESC NULLS LAST, o_totalprice ASC NULLS FIRST, o_orderkey LIMIT 100""",
)


@query("k7_distribute_sort", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def distribute_sort(t):
    """Rows spread by a composite key, then sorted within each task."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return rows.repartition("l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey", "l_linenumber")


_A = "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'"
_B = "SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'"
for _op in ("UNION", "UNION ALL", "INTERSECT", "INTERSECT ALL", "EXCEPT", "EXCEPT ALL"):
    _both("k8_set_" + _op.lower().replace(" ", "_"), f"{_A} {_op} {_B}")
_both("k8_set_minus", f"{_A} MINUS {_B}", f"{_A} EXCEPT {_B}")

_both(
    "k9_common_table_expressions",
    """WITH per_cust AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_custkey),
            busy AS (SELECT * FROM per_cust WHERE n > 5)
       SELECT c_name, n, top FROM busy JOIN customer ON c_custkey = o_custkey""",
)

_both(
    "k10_lateral_view",
    "SELECT word, count(*) AS n FROM documents LATERAL VIEW explode(split(text, ' ')) w AS word GROUP BY word",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word",
)
_both(
    "k10_lateral_view_outer",
    """SELECT p_partkey, word FROM part
       LATERAL VIEW OUTER explode(filter(split(p_name, ' '), x -> x LIKE '%r%')) w AS word""",
    """WITH w AS (SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x LIKE '%r%') AS ws FROM part)
       SELECT p_partkey, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS word FROM w""",
)


@query("k11_tablesample_percent", "SELECT 0 AS strangers, 0 AS repeated, true AS about_a_tenth, true AS same_again FROM orders LIMIT 1")
def tablesample_percent(t):
    """A sample by its properties: rows of the table, each once, about a tenth, the same for a seed."""
    text = "SELECT o_orderkey, o_totalprice FROM orders"
    drawn = f"{text} TABLESAMPLE (10 PERCENT) REPEATABLE (7)"
    parts = [t.sql(q).withColumn("part", F.lit(name)) for name, q in (("all", text), ("one", drawn), ("two", drawn))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("o_orderkey", "o_totalprice").agg(
        *[F.count(F.when(F.col("part") == name, 1)).alias(name) for name in ("all", "one", "two")])
    return rows.agg(
        F.count(F.when((F.col("one") > 0) & (F.col("all") == 0), 1)).cast("int").alias("strangers"),
        F.count(F.when(F.col("one") > F.col("all"), 1)).cast("int").alias("repeated"),
        (F.abs(F.sum("one") / F.sum("all") - 0.1) < 0.05).alias("about_a_tenth"),
        (F.count(F.when(F.col("one") != F.col("two"), 1)) == 0).alias("same_again"))


@query("k11_tablesample_rows", "SELECT 50 AS rows, 0 AS strangers FROM orders LIMIT 1")
def tablesample_rows(t):
    sample = t.sql("SELECT o_orderkey FROM orders TABLESAMPLE (50 ROWS)")
    known = sample.join(t.orders.select("o_orderkey").distinct().withColumn("_known", F.lit(1)), "o_orderkey", "left")
    return known.agg(F.count("*").cast("int").alias("rows"), F.count(F.when(F.col("_known").isNull(), 1)).cast("int").alias("strangers"))


@query("k11_sample_rows", """SELECT 500 AS n, 0 AS strangers, true AS spread_out, true AS same_again FROM orders LIMIT 1""")
def sample_rows(t):
    """Drawn rows are of the table, spread over it, and the same under another partitioning."""
    rows = t.orders.select("o_orderkey", "o_custkey")
    one, two = (rel.sample_rows(df, 500, 7) for df in (rows, rows.repartition(7, "o_custkey")))
    both = one.withColumn("one", F.lit(1)).unionByName(two.withColumn("two", F.lit(1)), allowMissingColumns=True)
    known = rows.distinct().withColumn("known", F.lit(1))
    per = both.groupBy("o_orderkey", "o_custkey").agg(F.count("one").alias("one"), F.count("two").alias("two")).join(known, ["o_orderkey", "o_custkey"], "left")
    middle = rows.agg(F.avg("o_orderkey")).head()[0]
    return per.agg(
        F.sum("one").cast("int").alias("n"), F.count_if(F.col("known").isNull()).cast("int").alias("strangers"),
        F.count_if(F.col("o_orderkey") > middle).between(150, 350).alias("spread_out"), (F.count_if(F.col("one") != F.col("two")) == 0).alias("same_again"))


@query("k11_tablesample_bucket", "SELECT o_orderkey FROM orders WHERE o_custkey % 4 = 0")
def tablesample_bucket(t):
    return t.orders.where(F.pmod("o_custkey", F.lit(4)) == 0).select("o_orderkey")


_both(
    "k12_inline_values",
    """SELECT o_orderkey, v.label FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', NULL)) AS v(code, label)
       ON o_orderstatus = v.code""",
)
_both(
    "k13_scalar_subquery",
    """SELECT o_orderkey, o_totalprice - (SELECT max(c_acctbal) FROM customer) AS over_balance,
              (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_lines
       FROM orders""",
)
_both(
    "k13_row_subscript_struct",
    """SELECT vec_id, named_struct('a', label, 'b', vec_id).a AS a, CAST(embedding[0] AS DOUBLE) AS first_value,
              split(concat_ws('-', label, vec_id), '-')[1] AS tail,
              map('x', label)['x'] AS x, (label, vec_id) = (2, 0L) AS is_first
       FROM embeddings""",
    """SELECT vec_id, {'a': label, 'b': vec_id}.a AS a, CAST(embedding[1] AS DOUBLE) AS first_value,
              string_split(concat_ws('-', label, vec_id), '-')[2] AS tail,
              label AS x, (label = 2 AND vec_id = 0) AS is_first
       FROM embeddings""",
)
_both(
    "k14_case_cast_concat",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code,
              CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' END AS band,
              o_orderstatus || '/' || o_orderpriority AS label, CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank,
              date_format(o_orderdate, 'yyyy/MM/dd') AS day, try_cast(o_orderpriority AS INT) AS bad
       FROM orders""",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code,
              CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' END AS band,
              o_orderstatus || '/' || o_orderpriority AS label, CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank,
              strftime(o_orderdate, '%Y/%m/%d') AS day, TRY_CAST(o_orderpriority AS INT) AS bad
       FROM orders""",
)
_both(
    "k15_substring_position_trim",
    """SELECT p_partkey, substring(p_name FROM 2 FOR 3) AS mid, position(' ' IN p_name) AS gap,
              trim(BOTH 'rs' FROM p_name) AS both_ends, trim(LEADING 's' FROM p_name) AS lead_cut,
              trim(TRAILING 'g' FROM p_name) AS tail_cut FROM part""",
    """SELECT p_partkey, substring(p_name FROM 2 FOR 3) AS mid, CAST(position(' ' IN p_name) AS INTEGER) AS gap,
              trim(BOTH 'rs' FROM p_name) AS both_ends, trim(LEADING 's' FROM p_name) AS lead_cut,
              trim(TRAILING 'g' FROM p_name) AS tail_cut FROM part""",
)
_both(
    "k16_arithmetic",
    """SELECT o_orderkey, o_custkey + 1 AS a, o_custkey - 2 AS b, o_custkey * 3 AS c, o_custkey / 4 AS d,
              o_custkey % 5 AS e, o_custkey DIV 6 AS f, o_custkey & 12 AS g, o_custkey | 3 AS h, o_custkey ^ 5 AS i, ~o_custkey AS j
       FROM orders""",
    """SELECT o_orderkey, o_custkey + 1 AS a, o_custkey - 2 AS b, o_custkey * 3 AS c, o_custkey / 4 AS d,
              o_custkey % 5 AS e, o_custkey // 6 AS f, o_custkey & 12 AS g, o_custkey | 3 AS h, xor(o_custkey, 5) AS i, ~o_custkey AS j
       FROM orders""",
)
_both(
    "k17_interval_arithmetic",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 3 MONTH AS STRING) AS later,
              CAST(o_orderdate - INTERVAL '10' DAY AS STRING) AS sooner,
              CAST(o_orderdate + INTERVAL 90 MINUTE AS STRING) AS soon, current_date >= DATE '2020-01-01' AS modern
       FROM orders WHERE o_orderdate < CURRENT_TIMESTAMP - INTERVAL 1 DAY""",
    """SELECT o_orderkey, CAST(o_orderdate + INTERVAL 3 MONTH AS VARCHAR) AS later,
              CAST(o_orderdate - INTERVAL '10' DAY AS VARCHAR) AS sooner,
              CAST(o_orderdate + INTERVAL 90 MINUTE AS VARCHAR) AS soon, true AS modern
       FROM orders WHERE o_orderdate < TIMESTAMP '2020-01-01'""",
)
_both(
    "k18_case_insensitive_compare",
    """SELECT o_orderkey, o_orderpriority COLLATE UTF8_LCASE = '1-urgent' AS folded, o_orderpriority = '1-urgent' AS exact_case
       FROM orders WHERE lower(o_orderstatus) = lower('f')""",
    """SELECT o_orderkey, lower(o_orderpriority) = '1-urgent' AS folded, o_orderpriority = '1-urgent' AS exact_case
       FROM orders WHERE lower(o_orderstatus) = 'f'""",
)


@query("k19_create_set_table", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def create_set_table(t):
    """CREATE SET TABLE AS: duplicate rows are refused, here dropped before the write."""
    path = t.scratch("set-table")
    rel.duplicate_free(t.orders.select("o_custkey", "o_orderstatus")).write.parquet(path)
    return t.spark.read.parquet(path)


@query("k19_create_multiset_volatile", "SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 200000")
def create_multiset_volatile(t):
    """A multiset table keeps duplicates; a volatile one lives in the session as a view."""
    path = t.scratch("multiset")
    t.orders.select("o_custkey", "o_orderstatus", "o_totalprice").write.parquet(path)
    t.spark.read.parquet(path).createOrReplaceTempView("volatile_orders")
    return t.spark.sql("SELECT o_custkey, o_orderstatus FROM volatile_orders WHERE o_totalprice > 200000")


@query(
    "k20_update_from",
    """SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' AND o_totalprice < 200000 THEN o_totalprice + c_acctbal ELSE o_totalprice END AS o_totalprice,
              CASE WHEN c_mktsegment = 'BUILDING' AND o_totalprice < 200000 THEN 'U' ELSE o_orderstatus END AS o_orderstatus
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def update_from(t):
    source = t.customer.where("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    updated = rel.update_from(
        t.orders, source, ["o_custkey"],
        {"o_totalprice": "t.o_totalprice + s.c_acctbal", "o_orderstatus": "'U'"}, where="t.o_totalprice < 200000")
    return updated.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "k20_delete_matching",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH')",
)
def delete_matching(t):
    source = t.orders.where("o_orderpriority = '2-HIGH'").withColumnRenamed("o_custkey", "c_custkey")
    return rel.delete_matching(t.customer, source, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "k20_insert_select",
    "SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer UNION ALL SELECT -1, 'total'",
)
def insert_select(t):
    path = t.scratch("insert")
    t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")).write.parquet(path)
    t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).write.mode("append").parquet(path)
    t.spark.sql("SELECT * FROM VALUES (-1L, 'total') AS v(k, name)").write.mode("append").parquet(path)
    return t.spark.read.parquet(path)
