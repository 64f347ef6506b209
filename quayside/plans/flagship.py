"""The whole path of one table: scan, shape, clean, filter, deduplicate and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside import functions as fn
from quayside.operators import filters, load, schema
from quayside.operators.schema import ColumnSpec
from quayside.plans.registry import query

# The orders as a legacy feed would deliver them: all text, every order also in an older copy.
FEED = """
  SELECT cast(o_orderkey AS STRING) AS f_key, cast(o_custkey AS STRING) AS f_cust,
         cast(cast(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS f_price,
         replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', '') AS f_date,
         concat(' ', o_orderpriority, ' ') AS f_priority, o_orderstatus AS f_status, '2' AS f_version
  FROM orders
  UNION ALL
  SELECT cast(o_orderkey AS STRING), '~', '0.00', '20220230', o_orderpriority, '', '1' FROM orders"""

SPECS = [
    ColumnSpec("order_key", "bigint", "f_key"),
    ColumnSpec("cust_key", "bigint", "f_cust"),
    ColumnSpec("price", "decimal(18,2)", "f_price"),
    ColumnSpec("order_date", "date", "f_date", mask="yyyymmdd"),
    ColumnSpec("priority", "string", "f_priority"),
    ColumnSpec("status", "string", "f_status"),
    ColumnSpec("version", "int", "f_version"),
]


@query(
    "typed_order_load",
    """SELECT o_orderpriority AS priority, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
              count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS price,
              CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day
       FROM orders WHERE o_totalprice >= 1000 AND o_orderpriority <> '5-LOW' GROUP BY 1, 2""",
)
def typed_order_load(t):
    shaped = schema.typed_projection(t.sql(FEED), SPECS, rejects="rejects")
    clean = shaped.withColumns({
        "priority": fn.nvl_trim("priority", "none"),
        "state": fn.case_when_map(fn.empty_to_null("status"), {"F": "finished", "O": "open"}, "other"),
    })
    latest = load.dedup(clean, ["order_key"], ["version"])
    kept = filters.subset_filter(latest, "PRICE >= 1000 [and] priority <> '5-LOW' [and] order_date is not null")
    return kept.groupBy("priority", "state").agg(
        F.count("*").alias("n_orders"), F.sum("price").cast("double").alias("price"),
        F.min("order_date").cast("string").alias("first_day"))
