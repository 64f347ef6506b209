"""Scans of files written from the given tables, listings derived from them, and catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.plans.registry import query
from quayside.plans.shaping import CATALOG, column_catalog
from quayside.sources import columnar, delimited, fixed_width, jdbc, listing

CUSTOMER_LAYOUT = [("c_custkey", 12), ("c_name", 25), ("c_acctbal", 14), ("c_mktsegment", 12)]


@query(
    "a1_fixed_width_scan",
    """SELECT rpad(CAST(c_custkey AS VARCHAR), 12, ' ') AS c_custkey, rpad(c_name, 25, ' ') AS c_name,
              rpad(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR), 14, ' ') AS c_acctbal,
              rpad(c_mktsegment, 12, ' ') AS c_mktsegment FROM customer""",
)
def fixed_width_scan(t):
    path = t.scratch("fixed-width")
    exact = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    fixed_width.fixed_width_lines(exact, CUSTOMER_LAYOUT).write.option("compression", "gzip").text(path)
    return fixed_width.fixed_width_scan(t.spark, path, CUSTOMER_LAYOUT)


LAYOUTS = """
  SELECT o_orderkey AS loader_id, concat('a,b,', o_orderstatus) AS schema_text,
         CASE WHEN o_orderpriority LIKE '1%' THEN '1, 2 ,3' WHEN o_orderpriority LIKE '2%' THEN '1,2'
              WHEN o_orderpriority LIKE '3%' THEN '1,x,3' ELSE concat('4,5,', cast(o_custkey AS STRING)) END AS layout_text
  FROM orders"""


@query(
    "a2_layout_validate",
    f"""WITH l AS ({LAYOUTS})
        SELECT loader_id, CASE
          WHEN len(string_split(layout_text, ',')) <> 3 THEN 'Mismatch SCHEMA: 3 LAYOUT: ' || len(string_split(layout_text, ','))
          WHEN layout_text LIKE '%x%' THEN 'LAYOUT is not a list of whole numbers' END AS problem
        FROM l""",
)
def layout_validate(t):
    problem = fixed_width.layout_error("schema_text", "layout_text")
    return t.sql(LAYOUTS).select("loader_id", problem.alias("problem"))


@query(
    "a3_delimited_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS k, 'a|"' || o_orderpriority AS p,
              CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price FROM orders""",
)
def delimited_scan(t):
    path = t.scratch("delimited")
    rows = t.orders.select(
        F.col("o_orderkey").cast("string").alias("k"), F.concat(F.lit('a|"'), "o_orderpriority").alias("p"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"))
    rows.write.options(sep="|", quote='"', escape="\\", header=True).csv(path)
    return delimited.delimited_scan(t.spark, path, ["k", "p", "price"], sep="|", header_rows=1)


@query(
    "a3_delimited_scan_edges",
    "SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority AS p FROM orders",
)
def delimited_scan_edges(t):
    """Two header rows and one trailer per file come off each file, whatever its splits.

    A file holds a range of 50,000 order keys, so more orders make more files, not longer ones.
    """
    path = t.scratch("edges")
    part = F.floor(F.col("o_orderkey") / 50000).alias("part")
    body = t.orders.select(part, F.lit(1).alias("place"), F.concat_ws(",", "o_orderkey", "o_orderpriority").alias("value"))
    frame = t.orders.select(part).distinct().selectExpr(
        "part", "stack(3, 0, 'made by', 0, 'k,p', 2, 'end of file') AS (place, value)")
    (body.unionByName(frame).repartition("part").sortWithinPartitions("part", "place")
     .select("part", "value").write.partitionBy("part").text(path))
    return delimited.delimited_scan(t.spark, f"{path}/part=*", ["k", "p"], header_rows=2, footer_rows=1)


@query(
    "a5_jdbc_split_predicates",
    """WITH b AS (SELECT (month(o_orderdate) - 1) % 4 AS task FROM orders)
       SELECT CAST(task AS INTEGER) AS task, count(*) AS n FROM b GROUP BY 1""",
)
def jdbc_split_predicates(t):
    """The read tasks a month split would send to a database, counted on the order table."""
    predicates = jdbc.split_predicates(jdbc.Split("o_orderdate", "MM", 4))
    task = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
    return t.orders.groupBy(task.alias("task")).agg(F.count("*").alias("n"))


@query(
    "a5_jdbc_depth_splits",
    """SELECT count(*) AS n_rows, count(*) AS n_once, true AS even, true AS enough FROM orders""",
)
def jdbc_depth_splits(t):
    """Reads of a column that grows with the square of the key and holds one value in half its rows."""
    skewed = F.when(F.col("o_custkey") % 2 == 0, 5).otherwise(F.col("o_orderkey") * F.col("o_orderkey")).cast("long")
    rows = t.orders.select(F.when(F.col("o_orderkey") % 97 != 0, skewed).alias("k"), "o_orderkey")
    texts = jdbc.depth_predicates(rows, "k", 10, "o_orderkey")
    reads = rows.select(F.filter(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(texts)]), lambda i: i.isNotNull()).alias("reads"))
    sizes = reads.select(F.size("reads").alias("times"), F.get("reads", F.lit(0)).alias("read")).groupBy("read").agg(
        F.count("*").alias("n"), F.count_if(F.col("times") == 1).alias("once"))
    return sizes.agg(
        F.sum("n").alias("n_rows"), F.sum("once").alias("n_once"), (F.max("n") <= 1.5 * F.sum("n") / 10).alias("even"),
        (F.count("*") >= 10).alias("enough"))


@query(
    "a6_split_bucket_expr",
    """SELECT o_orderkey, day(o_orderdate)::INTEGER AS dd, month(o_orderdate)::INTEGER AS mm,
              year(o_orderdate)::INTEGER AS yyyy, strftime(o_orderdate, '%Y%m')::INTEGER AS yyyymm,
              strftime(o_orderdate, '%m%d')::INTEGER AS mmdd, strftime(o_orderdate, '%Y%m%d')::INTEGER AS yyyymmdd,
              (o_custkey % 8)::INTEGER AS modulo, true AS hash_in_range FROM orders""",
)
def split_bucket_expr(t):
    hashed = jdbc.split_bucket("o_custkey", "hashamp_hashbucket_hashrow", 8)
    return t.orders.select(
        "o_orderkey",
        *[jdbc.split_bucket("o_orderdate", how).alias(how.lower()) for how in jdbc.DATE_SPLITS],
        jdbc.split_bucket("o_custkey", "mod", 8).alias("modulo"),
        hashed.between(0, 7).alias("hash_in_range"),
    )


def _catalog_tables(t):
    return t.part.select(
        F.col("p_brand").alias("schema_name"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("table_name"),
        F.when(F.col("p_type") == "ECONOMY", "V").otherwise("T").alias("kind"))


@query(
    "a7_jdbc_catalog_profile",
    f"""WITH cat AS ({CATALOG}),
        tabs AS (SELECT p_brand AS schema_name, 't' || p_partkey AS table_name,
                        CASE WHEN p_type = 'ECONOMY' THEN 'V' ELSE 'T' END AS kind FROM part),
        keys AS (SELECT table_name, string_agg(col_name, ',' ORDER BY 10 - position) AS natural_keys
                 FROM cat WHERE source_code IN (3, 7) GROUP BY table_name),
        splits AS (SELECT table_name, string_agg(col_name, ',' ORDER BY position) AS split_candidates
                   FROM cat WHERE source_code IN (91, 93) GROUP BY table_name)
        SELECT schema_name, table_name, kind, natural_keys, split_candidates
        FROM tabs LEFT JOIN keys USING (table_name) LEFT JOIN splits USING (table_name)""",
)
def jdbc_catalog_profile(t):
    tables = _catalog_tables(t)
    cat = column_catalog(t).join(tables.select("schema_name", "table_name"), "table_name")
    named = cat.select(
        "schema_name", "table_name", F.col("col_name").alias("column_name"), "position", "source_code",
        F.when(F.col("source_code") == 91, "DATE").when(F.col("source_code") == 93, "TIMESTAMP(6)")
        .otherwise("VARCHAR2").alias("type_name"))
    keys = named.where("source_code IN (3, 7)").withColumn("position", 10 - F.col("position"))
    return jdbc.catalog_profile(tables, keys, named, "oracle")


@query(
    "a8_union_tables_views",
    """SELECT p_brand AS schema_name, p_name AS table_name FROM part WHERE p_size > 10
       UNION SELECT p_brand, p_name FROM part WHERE p_type = 'ECONOMY'""",
)
def union_tables_views(t):
    names = [F.col("p_brand").alias("schema_name"), F.col("p_name").alias("table_name")]
    return jdbc.union_tables_views(
        t.part.where("p_size > 10").select(*names), t.part.where("p_type = 'ECONOMY'").select(*names))


@query(
    "a9_system_schema_filter",
    """SELECT o_orderkey, o_orderpriority AS table_name FROM orders
       WHERE o_orderstatus <> 'F' AND o_orderpriority NOT LIKE '1%'""",
)
def system_schema_filter(t):
    named = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "SYS").otherwise(F.col("o_orderstatus")).alias("schema_name"),
        F.when(F.col("o_orderpriority").startswith("1"), "BIN$xy==$0").otherwise(F.col("o_orderpriority")).alias("table_name"))
    return jdbc.drop_system_tables(named, "oracle").drop("schema_name")


# A file listing with one data file per order, markers for some, and backups.
FILES = """
  SELECT concat('/in/files/', o_orderstatus, '/c', cast(o_custkey AS STRING), '_',
                replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', ''), '_', cast(o_orderkey AS STRING),
                CASE WHEN o_orderpriority LIKE '1%' THEN '.dat.gz' WHEN o_orderpriority LIKE '2%' THEN '.done_bkp'
                     WHEN o_orderpriority LIKE '3%' THEN '.DAT' ELSE '.dat' END) AS path,
         o_orderdate AS modified, o_custkey AS grp
  FROM orders"""


@query(
    "a10_file_select",
    f"""WITH f AS ({FILES}) SELECT path, replace(path, '/files/', '/files_archive/') AS archived FROM f
        WHERE regexp_full_match(string_split(path, '/')[-1], 'c[0-9]+_199[78].*\\.(dat|done_bkp)(.gz)?')
          AND NOT regexp_full_match(string_split(path, '/')[-1], '(.*done_bkp.*|.*done_backup.*|.*_bkp)')""",
)
def file_select(t):
    chosen = listing.select_files(t.sql(FILES), r"c[0-9]+_199[78].*\.(dat|done_bkp)", allow_gz=True)
    return chosen.select("path", listing.archive_path().alias("archived"))


@query(
    "a10_folder_walk",
    "SELECT o_orderstatus, left(o_orderpriority, 1) AS priority, count(*) AS lines, true AS as_listed FROM orders GROUP BY ALL",
)
def folder_walk(t):
    """Files of a tree two folders deep, listed by tasks; each file's lines are counted by its folders."""
    path = t.scratch("tree")
    rows = t.orders.select("o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderkey").cast("string").alias("value"))
    rows.write.partitionBy("o_orderstatus", "priority").text(path)
    name = F.substring_index("path", "/", -3)
    walked = listing.walk_files(t.spark, path).select(name.alias("name"), "length")
    listed = listing.list_files(t.spark, path, sub_folders=True).select(name.alias("_name"), F.col("length").alias("_length"), F.lit(True).alias("_known"))
    both = walked.join(listed, (F.col("name") == F.col("_name")) & (F.col("length") == F.col("_length")), "full_outer")
    file = F.substring_index(F.col("_metadata.file_path"), "/", -3)
    lines = t.spark.read.option("recursiveFileLookup", True).text(path).groupBy(file.alias("_file")).agg(F.count("*").alias("n"))
    folder = lambda k: F.regexp_extract("name", f"{k}=([^/]*)", 1).alias(k)
    return both.join(lines, F.col("name") == F.col("_file"), "left").groupBy(folder("o_orderstatus"), folder("priority")).agg(
        F.sum("n").alias("lines"), F.bool_and(F.coalesce(F.col("_known") & F.col("name").isNotNull(), F.lit(False))).alias("as_listed"))


@query(
    "a11_files_modified_after",
    f"""WITH f AS ({FILES}) SELECT grp, max_by(path, struct_pack(m := modified, p := path)) AS path,
               CAST(max(modified) AS VARCHAR) AS modified
        FROM f WHERE modified >= TIMESTAMP '1997-06-30 00:00:01' GROUP BY grp""",
)
def files_modified_after(t):
    newer = listing.files_after(t.sql(FILES), "1997-06-30 00:00:00")
    return listing.newest_file(newer, "grp").withColumn("modified", F.col("modified").cast("string"))


@query("a12_files_for_date", f"WITH f AS ({FILES}) SELECT path FROM f WHERE contains(path, '_19950619_')")
def files_for_date(t):
    return listing.files_for_date(t.sql(FILES), "_19950619_").select("path")


@query(
    "a13_ready_marker_gate",
    f"""WITH f AS ({FILES}), d AS (
          SELECT grp, path, path NOT LIKE '%DAT' AS marked FROM f WHERE path LIKE '%.dat' OR path LIKE '%.DAT')
        SELECT 'c' || grp AS table_name, count(*) AS n_files, count(*) FILTER (WHERE NOT marked) AS n_unmarked,
               bool_and(marked) AS ready FROM d GROUP BY grp""",
)
def ready_marker_gate(t):
    files = t.sql(FILES)
    data = files.where("path LIKE '%.dat' OR path LIKE '%.DAT'")
    done = data.where("path LIKE '%.dat'").select(F.replace(F.col("path"), F.lit(".dat"), F.lit(".done")).alias("path"))
    named = data.select(F.concat(F.lit("c"), F.col("grp").cast("string")).alias("table_name"), "path")
    return listing.ready_tables(named, done.unionByName(data.select("path")), ".dat", ".done")


def _round_trip(name: str, fmt: str) -> None:
    @query(
        name,
        "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem",
    )
    def scan(t):
        path = t.scratch(fmt)
        columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"]
        wide = t.lineitem.select(*columns, "l_shipdate")
        options = {"header": True} if fmt == "csv" else {}
        wide.write.format(fmt).options(**options).save(path)
        if fmt in ("csv", "json"):
            back = t.spark.read.schema(wide.schema).options(**options).format(fmt).load(path)
            return back.select(*columns)
        return columnar.columnar_scan(t.spark, path, fmt, columns)


for _fmt in ("parquet", "orc", "csv", "json"):
    _round_trip(f"a15_columnar_scan_{_fmt}", _fmt)
