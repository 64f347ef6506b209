"""Script analytics: one SQL script per order, its text put together from the order's values."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import scripts
from quayside.plans.registry import query

SCRIPTS = """
  SELECT concat('/sql/', cast(o_custkey AS STRING), '/', cast(o_orderkey AS STRING), '.sql') AS path,
    concat('-- load of ; one order', chr(10), 'USE SCHEMA s', cast(o_custkey AS STRING), ';', chr(10),
      'SET run_day = ''', substr(cast(o_orderdate AS STRING), 1, 10), ''';', chr(10), 'SET prio=''', o_orderpriority, ''';', chr(10),
      '/* staging ; of', chr(10), ' it */ CREATE TEMPORARY TABLE stg.t', cast(o_orderkey AS STRING), ' AS SELECT * FROM src_', o_orderstatus,
      '.orders o, ref_', substr(o_orderpriority, 1, 1), '_DB.prio p WHERE o.x = p.x;', chr(10),
      CASE WHEN o_orderstatus = 'F' THEN 'DELETE FROM mart.facts WHERE k IN (SELECT k FROM stg.gone);'
           WHEN o_orderstatus = 'O' THEN 'update mart.facts set x = 1; -- done'
           ELSE 'SELECT 1 FROM mart.facts;' END, chr(10),
      'insert into "mart"."f#1" select a from stg.t', cast(o_orderkey AS STRING), ' where b in (select b from dim.b);', chr(10),
      CASE WHEN o_orderpriority LIKE '1%' THEN 'MERGE INTO mart.m USING stg.x ON 1 = 1; DROP TABLE stg.x;'
           WHEN o_orderpriority LIKE '2%' THEN concat('INSERT INTO q.r VALUES (''a;b -- c'');', chr(10),
             'insert into q.s select a from raw.l x left join raw.r on x.a = r.a join "raw"."o#" z on 1 = 1;') ELSE '' END) AS text
  FROM orders"""

_PIECE = r"""''[^'']*''?|"[^"]*"?|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)|;|[^''"/;-]+|[/-]"""
_CUT = (
    f"string_split(array_to_string(list_transform(list_filter(regexp_extract_all(text, '{_PIECE}'), "
    "lambda x: NOT starts_with(x, '--') AND NOT starts_with(x, '/*')), lambda x: CASE WHEN x = ';' THEN chr(1) ELSE x END), ''), chr(1))"
)
STATEMENTS = f"""scr AS ({SCRIPTS}), cut AS (
    SELECT path, unnest({_CUT}) AS raw, unnest(range(1, 1 + len({_CUT}))) AS n FROM scr),
  st AS (SELECT path, CAST(n AS INTEGER) AS n, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS statement FROM cut),
  stmts AS (SELECT path, n, statement,
      CASE WHEN regexp_matches(statement, '(?i)^(?:CREATE\\s*(?:TEMPORARY\\s*)?TABLE|INSERT\\s*INTO|UPDATE|DELETE\\s*FROM|DROP|MERGE)') THEN 'kept'
           WHEN regexp_matches(statement, '(?i)^(?:USE|SET)') THEN 'session' ELSE 'skipped' END AS kind
    FROM st WHERE statement <> '')"""
_VERB = r"upper(regexp_extract(statement, '(?i)^\s*(CREATE|INSERT|UPDATE|DELETE|DROP|MERGE)', 1))"
_TARGET = (
    r"nullif(regexp_extract(statement, '(?i)^\s*(?:CREATE\s*(?:TEMPORARY)?\s*TABLE|INSERT\s*INTO|UPDATE|DELETE\s*FROM|DROP\s*TABLE|MERGE\s*INTO)"
    r"\s*([\"#a-zA-Z0-9_$\{\}.]+)', 1), '')"
)
# The check engine has no look-behind: DELETE FROM is taken out before tables are looked for.
_READS = (
    r"list_filter(list_transform(flatten(list_transform(regexp_extract_all(regexp_replace(statement, '(?i)DELETE\s+FROM', ' ', 'g'), "
    r"'(?i)\b(?:FROM|JOIN|USING)\s+((?:[\"#\w]+\.[\"#\w]+(?:[\"#\s\w]*,\s+)?)+)', 1), lambda l: string_split(l, ','))), "
    r"lambda x: regexp_split_to_array(trim(x), '\s+')[1]), lambda x: x <> '')"
)


def _statements(t):
    return scripts.statements(t.sql(SCRIPTS))


@query("j1_script_statements", f"WITH {STATEMENTS} SELECT path, n, statement, kind FROM stmts")
def script_statements(t):
    return _statements(t)


@query("j2_statement_target",
       f"WITH {STATEMENTS} SELECT path, n, {_VERB} AS write_type, {_TARGET} AS target FROM stmts WHERE kind = 'kept'")
def statement_target(t):
    return _statements(t).where("kind = 'kept'").select(
        "path", "n", scripts.write_type().alias("write_type"), scripts.target_table().alias("target"))


@query("j3_statement_reads",
       f"WITH {STATEMENTS} SELECT path, n, array_to_string({_READS}, ',') AS reads FROM stmts")
def statement_reads(t):
    return _statements(t).select("path", "n", F.array_join(scripts.read_tables(), ",").alias("reads"))


EDGES = f"""{STATEMENTS}, rd AS (SELECT path, n, {_VERB} AS write_type, {_TARGET} AS write_table, {_READS} AS reads FROM stmts WHERE kind = 'kept'),
  edges AS (SELECT path, n, write_type, write_table, unnest(CASE WHEN len(reads) = 0 THEN [NULL] ELSE reads END) AS read_table FROM rd)"""


@query("j4_dependency_edges", f"WITH {EDGES} SELECT * FROM edges")
def dependency_edges(t):
    return scripts.dependency_edges(_statements(t))


# Names as the scripts spell them, with what they are called now. Staging tables follow the orders.
MAPPING = """
  SELECT concat('stg.t', cast(o_orderkey AS STRING)) AS source_name, concat('NEW_', o_orderstatus, '.T', cast(o_orderkey AS STRING)) AS target_name,
         CASE WHEN o_orderpriority LIKE '2%' THEN 'WRITE' ELSE 'READ' END AS operation FROM orders
  UNION ALL SELECT concat('src_', r_name, '.orders'), 'X.Y', 'READ' FROM region
  UNION ALL SELECT DISTINCT concat('src_', o_orderstatus, '.orders'), concat('RAW_', o_orderstatus, '_PROCS_', '.ORDERS'), 'READ' FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT DISTINCT 'mart.f_1', 'MART_DB.FACT', 'WRITE' FROM orders"""


@query(
    "j5_schema_remap",
    f"""WITH {EDGES}, m AS ({MAPPING}), c AS (
          SELECT *, regexp_replace(replace(write_table, '"', ''), '[^.\\w-]+', '_', 'g') AS w,
                 regexp_replace(replace(read_table, '"', ''), '[^.\\w-]+', '_', 'g') AS r FROM edges)
        SELECT path, n, write_type, coalesce(mw.target_name, write_table) AS write_table, coalesce(mr.target_name, read_table) AS read_table
        FROM c LEFT JOIN m mw ON mw.operation = 'WRITE' AND mw.source_name = w
               LEFT JOIN m mr ON mr.operation = 'READ' AND mr.source_name = r""",
)
def schema_remap(t):
    return scripts.remap_tables(scripts.dependency_edges(_statements(t)), t.sql(MAPPING))


@query(
    "j6_session_params",
    f"""WITH scr AS ({SCRIPTS})
        SELECT path, 'set' AS kind, unnest(regexp_extract_all(text, 'SET\\s+(\\w+)\\s*=\\s*''([^'']*)''', 1)) AS name,
               unnest(regexp_extract_all(text, 'SET\\s+(\\w+)\\s*=\\s*''([^'']*)''', 2)) AS value FROM scr
        UNION ALL SELECT path, 'use', NULL, unnest(regexp_extract_all(text, '(USE\\s+(?:SCHEMA|DATABASE)\\s+\\w+);', 1)) FROM scr""",
)
def session_params(t):
    return scripts.session_params(t.sql(SCRIPTS))


@query(
    "j7_consecutive_groups",
    """WITH e AS (SELECT user_id, event_id, CASE WHEN event_type <> 'view' THEN event_type END AS env FROM events),
            b AS (SELECT *, lag(env) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM e)
       SELECT user_id, event_id, env, CAST(1 + sum(CASE WHEN prev IS NOT NULL AND prev IS DISTINCT FROM env THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS group_no FROM b""",
)
def consecutive_groups(t):
    stmts = t.events.select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("env"))
    return scripts.consecutive_groups(stmts, "user_id", "event_id", "env", stretch=1000)


@query(
    "j8_temp_table_stage",
    f"""WITH {STATEMENTS}, m AS ({MAPPING}), cr AS (
          SELECT path, n, regexp_extract(statement, '(?i)^\\s*CREATE\\s*(?:TEMPORARY)?\\s*TABLE\\s*(["#a-zA-Z0-9_$\\{{\\}}.]+)', 1) AS temp_table,
                 {_READS} AS reads FROM stmts),
        ex AS (SELECT path, n, temp_table, unnest(reads) AS read_table, unnest(range(len(reads))) AS place FROM cr WHERE temp_table <> ''),
        db AS (SELECT ex.*, split_part(coalesce(m.target_name, read_table), '.', 1) AS database
               FROM ex LEFT JOIN m ON m.operation = 'READ' AND m.source_name = read_table),
        pick AS (SELECT * FROM db QUALIFY row_number() OVER (PARTITION BY path, n
                   ORDER BY NOT regexp_matches(upper(database), '_DB$|_PROCS_'), place) = 1),
        stages AS (SELECT DISTINCT concat('ref_', substr(o_orderpriority, 1, 1), '_DB') AS database, 'stage' || substr(o_orderpriority, 1, 1) AS stage FROM orders)
        SELECT path, n, temp_table, database, stage FROM pick LEFT JOIN stages USING (database)""",
)
def temp_table_stage(t):
    digit = F.substring("o_orderpriority", 1, 1)
    stages = t.orders.select(
        F.concat(F.lit("ref_"), digit, F.lit("_DB")).alias("database"), F.concat(F.lit("stage"), digit).alias("stage")).distinct()
    return scripts.temp_table_stages(_statements(t), t.sql(MAPPING), stages).select("path", "n", "temp_table", "database", "stage")


QUOTED = "'''(.*)'''"
EXPRESSIONS = """
  SELECT o_orderkey AS k,
    CASE WHEN o_orderpriority LIKE '1%' THEN concat('(CASE WHEN :st_', cast(o_custkey AS STRING), ' = ''F'' THEN 1 END)')
         WHEN o_orderpriority LIKE '2%' THEN concat('CURRENT_TIMESTAMP(', cast(o_custkey AS STRING), ')')
         WHEN o_orderpriority LIKE '3%' THEN concat(':name_', cast(o_custkey AS STRING), ' (CASESPECIFIC) ')
         WHEN o_orderpriority LIKE '4%' THEN concat('DIVIDE(:amount, ', cast(o_custkey AS STRING), ' )')
         WHEN o_orderstatus = 'F' THEN concat(':first||''-', cast(o_custkey AS STRING), '''||:last')
         ELSE concat(':stamp_', cast(o_custkey AS STRING), ' (TIMESTAMP(6))') END AS expression
  FROM orders"""


@query(
    "j9_loader_rewrite",
    f"""WITH e AS ({EXPRESSIONS})
        SELECT k, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(expression,
            '\\(CASESPECIFIC\\)', '', 'g'),
            'CURRENT_TIMESTAMP\\(\\d+\\)', 'CURRENT_TIMESTAMP()', 'g'),
            '\\(\\s*CASE\\s+WHEN\\s+(.*)\\s+END\\s*\\)', 'CASE WHEN \\1 END', 'g'),
            '(:[a-zA-Z_0-9]+)\\s*\\(TIMESTAMP\\(6\\)\\)', 'nvl2(to_timestamp(\\1,yyyy-MM-dd HH:mm:ss.SSS''Z''),NULL)', 'g')) AS v FROM e""",
)
def loader_rewrite(t):
    return t.sql(EXPRESSIONS).select("k", scripts.rewrite("expression").alias("v"))


@query(
    "j10_expr_function_match",
    f"""WITH e AS ({EXPRESSIONS}), u AS (SELECT k, upper(trim(expression)) AS x FROM e)
        SELECT k, CASE WHEN x LIKE 'DIVIDE%' THEN 'divide' WHEN contains(x, '||') THEN 'concat_columns'
                       WHEN regexp_matches(x, 'WHEN\\s*?:[A-Z_]+\\s+=') THEN NULL END AS function,
               CASE WHEN x LIKE 'DIVIDE%' THEN regexp_extract(x, '(\\d+)', 1)
                    WHEN contains(x, '||') THEN ':FIRST|' || regexp_extract(x, '''(.*)''', 1) || '|:LAST' END AS params
        FROM u""",
)
def expr_function_match(t):
    hit = t.sql(EXPRESSIONS).select("k", scripts.match_function("expression").alias("hit"))
    return hit.select("k", "hit.function", F.array_join("hit.params", "|").alias("params"))


@query(
    "j10_rule_table",
    f"""WITH e AS ({EXPRESSIONS}), u AS (SELECT k, upper(trim(expression)) AS x FROM e)
        SELECT k, CASE WHEN x LIKE 'DIVIDE%' THEN 'divide' WHEN contains(x, '||') THEN 'concat_columns' END AS function,
               CASE WHEN x LIKE 'DIVIDE%' THEN regexp_extract(x, '(\\d+)', 1)
                    WHEN contains(x, '||') THEN ':FIRST|' || regexp_extract(x, {QUOTED}, 1) || '|:LAST' END AS params
        FROM u""",
)
def rule_table(t):
    """A rule for a function named after each order, ahead of the listed ones; an expression meets
    only those filed under its letters."""
    letters = F.translate(F.col("o_orderkey").cast("string"), "0123456789", "ABCDEFGHIJ")
    named = t.orders.select(F.col("o_orderkey").cast("int").alias("place"), F.concat(F.lit("XYZ"), letters).alias("function"))
    named = named.select("place", F.concat(F.reverse("function"), F.lit(r"\s*\(")).alias("pattern"), "function", F.lit("single").alias("search")).distinct()
    listed = [F.struct(F.lit(10**9 + i).alias("place"), F.lit(p).alias("pattern"), F.lit(f).alias("function"), F.lit(s).alias("search"))
              for i, (p, f, s) in enumerate(scripts.FUNCTION_RULES)]
    rules = named.unionByName(t.spark.range(1).select(F.inline(F.array(*listed))))
    hit = scripts.match_rules(t.sql(EXPRESSIONS), ["k"], "expression", scripts.rule_table(rules))
    return hit.select("k", "function", F.array_join("params", "|").alias("params"))


INSERTS = """
  SELECT o_orderkey AS k, concat('id,', o_orderstatus, ',prio,total') AS cols,
         concat(cast(o_orderkey AS STRING), ',', CASE WHEN o_orderstatus = 'F' THEN 'NULL' ELSE ':s' END, ',',
                CASE WHEN o_orderpriority LIKE '1%' THEN 'NULL' ELSE o_orderpriority END, ',NULLIF') AS vals
  FROM orders"""


@query(
    "j11_drop_null_targets",
    f"""WITH i AS ({INSERTS}), z AS (
          SELECT k, list_filter(list_zip(string_split(cols, ','), string_split(vals, ',')), lambda p: p[2] <> 'NULL') AS kept FROM i)
        SELECT k, array_to_string(list_transform(kept, lambda p: p[1]), ',') AS cols,
               array_to_string(list_transform(kept, lambda p: p[2]), ',') AS vals FROM z""",
)
def drop_null_targets(t):
    split = t.sql(INSERTS).select("k", F.split("cols", ",").alias("c"), F.split("vals", ",").alias("v"))
    kept = split.withColumn("kept", scripts.drop_null_targets("c", "v"))
    return kept.select("k", F.array_join("kept.column", ",").alias("cols"), F.array_join("kept.value", ",").alias("vals"))
