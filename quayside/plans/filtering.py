"""Row filters over orders, lines and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import filters
from quayside.plans.registry import add, query

_KEYS = ("l_orderkey", "l_linenumber")


def _subset(name: str, rule: str, where: str) -> None:
    add(
        name,
        lambda t: filters.subset_filter(t.lineitem, rule).select(*_KEYS),
        f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {where}",
    )


_subset("d1_subset_filter_equal", "L_RETURNFLAG = A [and] l_linenumber <> 3", "l_returnflag = 'A' AND l_linenumber <> 3")
_subset("d1_subset_filter_range", "l_quantity >= 10 [AND] L_Quantity < 20 [and] l_tax <= 0.04 [and] l_discount > 0.02",
        "l_quantity >= 10 AND l_quantity < 20 AND l_tax <= 0.04 AND l_discount > 0.02")
_subset("d1_subset_filter_in", "l_linenumber in (1, 2) [and] l_returnflag not in ('A', 'N')",
        "l_linenumber IN (1, 2) AND l_returnflag NOT IN ('A', 'N')")
_subset("d1_subset_filter_mixed", "l_linenumber = 1 [or] l_linestatus like 'F%' [and] l_returnflag rlike '^[AR]$'",
        "l_linenumber = 1 OR (l_linestatus LIKE 'F%' AND regexp_matches(l_returnflag, '^[AR]$'))")
_subset("d1_subset_filter_null", "l_returnflag IS NOT NULL [and] l_linestatus not like 'O%' [and] l_quantity <=> 7",
        "l_returnflag IS NOT NULL AND l_linestatus NOT LIKE 'O%' AND l_quantity IS NOT DISTINCT FROM 7")


@query(
    "d2_delete_where",
    "SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price FROM orders) WHERE price IS NULL OR NOT price < 250000",
)
def delete_where(t):
    priced = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    return filters.delete_where(priced, "price < 250000")


@query(
    "d3_selective_insert",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000",
)
def selective_insert(t):
    kept = filters.selective_insert(t.orders, "o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000")
    return kept.select("o_orderkey", "o_orderpriority")


# One loader table per customer, its clauses drawn from the customer's orders.
CLAUSES = """
  SELECT o_custkey AS table_id,
         CASE WHEN o_orderstatus = 'F' THEN '' ELSE concat('(status = ', o_orderstatus, ')') END AS delete_clause,
         CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE concat('(priority = ', substr(o_orderpriority, 1, 1), ')') END AS insert_clause
  FROM orders"""


@query(
    "d4_combine_conditions",
    f"""WITH c AS ({CLAUSES})
        SELECT table_id,
          string_agg(DISTINCT nullif(delete_clause, ''), ' OR ' ORDER BY nullif(delete_clause, '')) AS delete_clause,
          string_agg(DISTINCT insert_clause, ' OR ' ORDER BY insert_clause) AS insert_clause
        FROM c GROUP BY table_id""",
)
def combine_conditions(t):
    return filters.combine_conditions(t.sql(CLAUSES), "table_id", "delete_clause", "insert_clause")


@query(
    "d5_high_water_filter",
    "SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'",
)
def high_water_filter(t):
    import datetime

    newer = filters.high_water_filter(t.orders, ["o_orderdate"], datetime.datetime(1998, 1, 1))
    return newer.select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))


@query("d5_next_high_water", "SELECT CAST(max(greatest(l_shipdate, l_shipdate)) AS VARCHAR) AS high_water_mark FROM lineitem")
def next_high_water(t):
    return filters.next_high_water(t.lineitem, ["l_shipdate"]).select(
        F.col("high_water_mark").cast("string").alias("high_water_mark"))


@query(
    "d6_name_regex_filter",
    r"SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue) .*') OR regexp_matches(p_name, '.*ring$') OR p_type = 'ECONOMY'",
)
def name_regex_filter(t):
    tagged = t.part.withColumn("tags", F.array("p_type", "p_brand"))
    return filters.name_filter(tagged, "p_name", ["^(red|blue) .*", ".*ring$"], "tags", "ECONOMY").select("p_partkey", "p_name")
