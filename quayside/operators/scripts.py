"""SQL scripts as data: a DataFrame of ``path`` and ``text`` in, statements and edges out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.relational import join_back, running_total
from quayside.session import saved

BLANKS = " \t\n\x0b\f\r"
# A script in pieces: quoted texts and names, comments, statement ends, and what lies between.
PIECE = r"""'[^']*'?|"[^"]*"?|--[^\n]*|/\*(?s:.*?)(?:\*/|\z)|;|[^'"/;-]+|[/-]"""
CUT = "\x01"
# A statement in words: quoted texts, names with their quoted and ${} parts, and marks of lists.
WORD = r"""'[^']*'?|(?:"[^"]*"?|\$\{\w*\}|[\w#$.]+)+|[(),]"""
# What words are made of, and what lies between words other than marks and texts.
IN_WORD, GAP = r"""[\w#$."{}]""", r"""[^\w#$."'(),]"""
PLAIN_NAME = r"""\$\{\w*\}|["][^"\s(),']*["]"""
VERBS = ("CREATE", "INSERT", "UPDATE", "DELETE", "DROP", "MERGE")
# Words that may stand between a verb and the table it writes.
FILLERS = ("OR", "REPLACE", "GLOBAL", "TEMPORARY", "TEMP", "VOLATILE", "MULTISET", "SET", "TABLE", "INTO", "OVERWRITE", "FROM", "IF", "NOT", "EXISTS")
OPENERS = ("FROM", "JOIN", "USING")
# Words and marks that end a list of tables.
CLOSERS = ("WHERE", "GROUP", "ORDER", "HAVING", "QUALIFY", "ON", "SET", "SELECT", "WHEN", "UNION", "LIMIT", "VALUES", "(", ")")
# The statements that count.
KEPT = r"(?i)^(?:CREATE\s*(?:TEMPORARY\s*)?TABLE|INSERT\s*INTO|UPDATE|DELETE\s*FROM|DROP|MERGE)"
SESSION = r"(?i)^(?:USE|SET)"
SET_VALUE = r"SET\s+(\w+)\s*=\s*'([^']*)'"

# Letters of a rule's required literal under which it is filed, and the most that are compared whole.
GRAM, LITERAL = 3, 32
# Rules that are sent to all tasks; more meet the expressions in a shuffle.
SENT_RULES = 20_000

# Rewrites of loader expressions, applied in this order.
REWRITES = [
    (r"\(CASESPECIFIC\)", ""),
    (r"CURRENT_TIMESTAMP\(\d+\)", "CURRENT_TIMESTAMP()"),
    (r"\(\s*CASE\s+WHEN\s+(.*)\s+END\s*\)", "CASE WHEN $1 END"),
    (r"\(\s*CASE\s+WHEN\s+(.*)\s+END\s*\(DATE\s*,\s*FORMAT\s*('.*')\)\)", "CASE WHEN $1 END,$2"),
    (r"to_date\(\(\s*CASE\s+WHEN\s+(.*)\s+END\s*,\s*('.*')", "to_date(CASE WHEN $1 END, $2"),
    (r"(:[a-zA-Z_0-9]+)\s*\(TIMESTAMP\(6\)\)", "nvl2(to_timestamp($1,yyyy-MM-dd HH:mm:ss.SSS'Z'),NULL)"),
    (r"(:[a-zA-Z_0-9]+)\s*=\s*'\s*'", r"trim(regexp_replace($1,'[\\\\s\\\\n]+','')) = ''"),
    (r"(:[a-zA-Z_0-9]+)\s*<>\s*'\s*'", r"trim(regexp_replace($1,'[\\\\s\\\\n]+','')) <> ''"),
]

# Loader expressions and the column function each stands for, first match first.
FUNCTION_RULES = [
    (r"UPPER", "upper", "single"),
    (r"NULLIF\s*\(.*\s*,'([^A-Za-z0-9])'\)(?!.*TO_TIMESTAMP|.*TO_DATE)", "nullif_text", "single"),
    (r"NULLIF\s*\(.*\s*,'(.*)'\)\s*TO_TIMESTAMP\s*\(?'(.*?)'\)?", "nullif_to_timestamp", "single"),
    (r"NULLIF\s*\(.*\s*,'(.*)'\)\s*TO_DATE\s*\(?'(.*?)'\)?", "nullif_to_date", "single"),
    (r"CASE\s*WHEN.*\s*'(.*)'\s*THEN.*NULL.*DATE.*\(?'(.*?)'\)?", "nullif_to_date", "single"),
    (r"CASE\s+?WHEN\s+:[a-zA-Z_]+\s+(.*)THEN\s+?NULL\s+ELSE.*END(?!.*DATE)", "empty_to_null_date", "single"),
    (r"CASE\s*?WHEN\s*\(?:[a-zA-Z_]+\s*NE\s*'?([\w\s_])'?\)\s*THEN\s*\(?'?(.*?)'?\)?\s*ELSE\s*\(?\'?([\w\d]+)\'?\)?\s*END"
     r"\s+\(DATE,\s*FORMAT\s*'(.*?)'.*", "date_or_sentinel_ne", "single"),
    (r"CASE\s+?WHEN\s+\(?:[a-zA-Z_]+\)?\s+(.*)THEN\s+?'?(.*?)'?\s+ELSE\s*\'?(:[a-zA-Z_]+)\'?\s*END"
     r"\s+\(DATE,\s*FORMAT\s*'(.*?)'.*", "date_or_sentinel", "single"),
    (r"DIVIDE\(.*,\s*(\d+)\s*\)", "divide", "single"),
    (r"CASE\s*WHEN\s*.*NULL\s*THEN.*CURRENT_TIMESTAMP.*", "now_if_empty", "single"),
    (r"COALESCE\s*\(\s*NULLIF\s*\(.*\s*,\s*'(.*)'\)\s*,(.*)\)", "coalesce_nullif", "single"),
    (r"(?:\s*WHEN\s*?:[a-zA-Z_]+\s*(?:IS)?'?([a-zA-Z_\s]+)'?\s*THEN\s*(?!.*\d)'?([a-zA-Z_\s]+)'?)"
     r"(?:\s*ELSE\s*'?([a-zA-Z\?\s]+)'?\s*END)?", "case_when_map", "recursive"),
    (r"(?:\s*WHEN\s*?:[a-zA-Z_]+\s*(?:IS)?'?([a-zA-Z_\s]+)'?\s*THEN\s*'?([0-9]+)'?)"
     r"(?:\s*ELSE\s*'?(.*)'?\s*END)?", "case_when_map", "recursive"),
    (r"CUSTOM_SUBSTRING_CHARLENGTH", "right_after_rtrim", "single"),
    (r"STRINGTODATEFORMATHIVEUDF\s*\((\d+),?(?:'(.*)')?\)", "prefixed_date", "single"),
    (r"(:[a-zA-Z_\d]+)\|\|'(.*)'\|\|(:[a-zA-Z_\d]+)", "concat_columns", "single"),
]


def read_scripts(spark: SparkSession, path) -> DataFrame:
    """One row per file with its whole text."""
    files = spark.read.option("wholetext", True).text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def statements(scripts: DataFrame) -> DataFrame:
    """Statements of each script, numbered from one in script order.

    Quotes, comments and ends are told apart in one reading, so neither a semicolon in a comment
    nor one in a quoted text ends anything, and two dashes in a quoted text begin no comment. Comments
    are left out. ``kind`` is ``kept`` for statements that write, ``session`` for USE and SET,
    ``skipped`` for the rest.
    """
    read = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    told = F.filter(read, lambda x: ~(F.startswith(x, F.lit("--")) | F.startswith(x, F.lit("/*"))))
    pieces = F.split(F.array_join(F.transform(told, lambda x: F.when(x == ";", F.lit(CUT)).otherwise(x)), ""), CUT)
    trimmed = F.transform(pieces, lambda x: F.btrim(x, F.lit(BLANKS)))
    cut = scripts.select("path", F.posexplode(trimmed).alias("n", "statement"))
    cut = cut.select("path", (F.col("n") + 1).alias("n"), "statement")
    s = F.col("statement")
    kind = F.when(s.rlike(KEPT), "kept").when(s.rlike(SESSION), "session").otherwise("skipped")
    return cut.where(s != "").withColumn("kind", kind)


def _words(statement) -> Column:
    """The words and list marks of a statement, without its quoted texts."""
    return F.filter(F.regexp_extract_all(_col(statement), F.lit(WORD), F.lit(0)), lambda w: ~F.startswith(w, F.lit("'")))


def _col(name) -> Column:
    return F.col(name) if isinstance(name, str) else name


def _word(*words: str) -> str:
    """Pattern of whole words."""
    return rf"(?<!{IN_WORD})(?:{'|'.join(words)})(?!{IN_WORD})"


def _without_texts(statement) -> Column:
    """A statement whose quoted texts are blanks. Quoted names stay: see ``_odd_names``."""
    return F.regexp_replace(_col(statement), "'[^']*'?", " ")


def _odd_names(statement) -> Column:
    """Whether a quoted name or brace holds what would end a word elsewhere."""
    return F.regexp_replace(_col(statement), PLAIN_NAME, "").rlike('["{}]')


def _fold_reads(words: Column) -> Column:
    """``read_tables`` word by word, for statements with odd names."""
    def step(s, w):
        u = F.upper(w)
        opens = u.isin(*OPENERS) & ~((u == "FROM") & (s["last"] == "DELETE"))
        named = s["wants"] & w.contains(".")
        return F.struct(
            (opens | (s["lists"] & (u == ","))).alias("wants"),
            (opens | (s["lists"] & ~u.isin(*CLOSERS))).alias("lists"),
            u.alias("last"),
            F.when(named, F.concat(s["found"], F.array(w))).otherwise(s["found"]).alias("found"),
        )

    no = F.lit(False)
    start = F.struct(no.alias("wants"), no.alias("lists"), F.lit("").alias("last"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(words, start, step, lambda s: s["found"])


def _listed_reads(plain: Column) -> Column:
    """The same by three patterns. Where nothing closes it, a list goes on from its first opener;
    the statement is cut at the closers, and of each part names are taken behind opener or comma."""
    kept = F.regexp_replace(plain, rf"(?i){_word('DELETE')}{GAP}+{_word('FROM')}", " ")
    parts = F.split(kept, rf"(?i){_word(*(c for c in CLOSERS if c.isalpha()))}|[()]")
    opener = _word(*OPENERS)
    tail = lambda p: F.regexp_extract(p, rf"(?is){opener}.*", 0)
    return F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(tail(p), F.lit(rf"(?i)(?:,|{opener}){GAP}*(?!{opener})({IN_WORD}+)"), F.lit(1))))


def write_type(statement="statement") -> Column:
    """The verb of a statement that writes, else null."""
    verb = F.upper(F.regexp_extract(_col(statement), rf"(?i)^{GAP}*({'|'.join(VERBS)})(?!{IN_WORD})", 1))
    return F.when(verb != "", verb)


def target_table(statement="statement") -> Column:
    """The table a statement writes, as it is spelt there, else null.

    That is the first word behind the verb that is no filler; CREATE and DROP write tables only.
    """
    plain, verb = _without_texts(statement), write_type(statement)
    fillers = rf"(?:{GAP}+(?:{'|'.join(FILLERS)})(?!{IN_WORD}))*+"
    name = rf"""(?:"[^"]*"?|\$\{{\w*\}}|[\w#$.]+)+"""
    named = F.regexp_extract(plain, rf"(?i)^{GAP}*(?:{'|'.join(VERBS)}){fillers}{GAP}*({name})", 1)
    table = plain.rlike(rf"(?i){_word('TABLE')}") | ~verb.isin("CREATE", "DROP")
    return F.when(verb.isNotNull() & table & named.rlike(r'^[\w"#$]'), named)


def read_tables(statement="statement") -> Column:
    """Qualified tables after FROM, JOIN and USING, but not those of DELETE FROM; each once, in order."""
    listed = F.filter(_listed_reads(_without_texts(statement)), lambda w: w.contains("."))
    return F.array_distinct(F.when(_odd_names(statement), _fold_reads(_words(statement))).otherwise(listed))


def dependency_edges(stmts: DataFrame) -> DataFrame:
    """One row per statement and table read; a statement that reads nothing keeps one row."""
    return stmts.where("kind = 'kept'").select(
        "path", "n", write_type().alias("write_type"), target_table().alias("write_table"), F.explode_outer(read_tables()).alias("read_table"))


def clean_name(name) -> Column:
    """Name as mapping tables spell it: no quotes, other odd characters as underscores."""
    name = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(F.regexp_replace(name, '"+', ""), r"[^.\w-]+", "_")


def remap_tables(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace written and read tables by their mapped names; unmapped names stay.

    ``mapping``: source_name, target_name, operation (READ or WRITE), one row per name and operation.
    """
    def lookup(operation, out):
        rows = mapping.where(F.col("operation") == operation)
        return rows.select(F.col("source_name").alias(f"_{out}"), F.col("target_name").alias(f"_{out}_new"))

    mapped = edges.withColumns({"_w": clean_name("write_table"), "_r": clean_name("read_table")})
    for operation, column, key in (("WRITE", "write_table", "_w"), ("READ", "read_table", "_r")):
        rows = lookup(operation, column)
        mapped = mapped.join(rows, F.col(key) == F.col(f"_{column}"), "left")
        mapped = mapped.withColumn(column, F.coalesce(f"_{column}_new", column))
    return mapped.select(*edges.columns)


def session_params(scripts: DataFrame) -> DataFrame:
    """Session settings of each script: one row per SET name = 'value' and per USE."""
    text = F.col("text")
    names = F.regexp_extract_all(text, F.lit(SET_VALUE), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(SET_VALUE), F.lit(2))
    sets = F.transform(F.arrays_zip(names.alias("n"), values.alias("v")), lambda x: F.struct(
        F.lit("set").alias("kind"), x["n"].alias("name"), x["v"].alias("value")))
    used = statements(scripts).where("kind = 'session'").select("path", "statement", _words("statement").alias("_w"))
    chosen = (F.upper(F.get("_w", F.lit(0))) == "USE") & F.upper(F.get("_w", F.lit(1))).isin("SCHEMA", "DATABASE")
    uses = used.where(chosen).select("path", F.lit("use").alias("kind"), F.lit(None).cast("string").alias("name"), F.col("statement").alias("value"))
    return scripts.select("path", F.inline(sets)).unionByName(uses)


def consecutive_groups(stmts: DataFrame, script: str, n: str, env: str, stretch: int = 10_000) -> DataFrame:
    """Number the runs of consecutive statements that share an environment, per script.

    A statement opens a new group when the one before it has an environment and another one.
    A script's statements are cut into stretches by number: neighbours are compared within a
    stretch, the last environment of the stretch before is handed over, and group numbers add up
    over stretches, so a script with very many statements needs no task of its own.
    """
    parts = stmts.withColumn("_stretch", F.floor(F.col(n) / F.lit(stretch)))
    ends = parts.groupBy(script, "_stretch").agg(F.max_by(F.struct(env), n).alias("_end"))
    by_stretch = Window.partitionBy(script).orderBy("_stretch")
    handed = ends.select(script, "_stretch", F.lag("_end").over(by_stretch).alias("_handed"))
    within = Window.partitionBy(script, "_stretch").orderBy(n)
    compared = parts.withColumn("_before", F.lag(F.struct(env)).over(within))
    placed = join_back(compared, handed, [script, "_stretch"], ["_handed"])
    before = F.coalesce("_before", "_handed")[env]
    opens = before.isNotNull() & ~F.equal_null(F.col(env), before)
    flagged = placed.select(*stmts.columns, opens.cast("int").alias("_opens"))
    numbered = running_total(flagged, [script], [n], "_opens", F.floor(F.col(n) / F.lit(stretch)), "_total")
    return numbered.select(*stmts.columns, (F.col("_total") + 1).alias("group_no"))


def temp_table_stages(stmts: DataFrame, mapping: DataFrame, stages: DataFrame) -> DataFrame:
    """Stage of each created table: that of the first database it reads which ends in ``_DB`` or
    holds ``_PROCS_``, else of the first it reads.

    ``mapping`` as in ``remap_tables``; ``stages``: database, stage.
    """
    created = stmts.select(
        "path", "n", write_type().alias("verb"), target_table().alias("temp_table"),
        F.posexplode(read_tables()).alias("place", "read_table"),
    ).where("verb = 'CREATE' and temp_table is not null").drop("verb")
    reads = mapping.where("operation = 'READ'").select("source_name", "target_name")
    named = created.join(reads, clean_name("read_table") == F.col("source_name"), "left")
    database = F.substring_index(F.coalesce("target_name", "read_table"), ".", 1)
    preferred = F.upper(database).rlike("_DB$|_PROCS_")
    chosen = named.groupBy("path", "n", "temp_table").agg(
        F.min(F.struct((~preferred).alias("rest"), "place", database.alias("database"))).alias("first"))
    return chosen.select("path", "n", "temp_table", "first.database").join(stages, "database", "left")


def rewrite(expression, rules: Sequence[tuple[str, str]] = tuple(REWRITES)) -> Column:
    """Apply the rewrite rules in order, then trim."""
    result = F.col(expression) if isinstance(expression, str) else expression
    for pattern, replacement in rules:
        result = F.regexp_replace(result, pattern, replacement)
    return F.trim(result)


def _params(text: Column, pattern: str, search: str) -> Column:
    """Captured parameters: of the first match, or of all matches for a recursive rule."""
    import re

    groups = re.compile(pattern).groups
    if not groups:
        return F.array().cast("array<string>")
    if search == "single":
        found = F.array(*[F.regexp_extract(text, pattern, g) for g in range(1, groups + 1)])
    else:
        per_group = [
            F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in range(1, groups + 1)]
        rows = F.arrays_zip(*per_group)
        found = F.flatten(F.transform(rows, lambda r: F.array(*[r[f"g{g}"] for g in range(1, groups + 1)])))
    return F.filter(F.transform(found, lambda p: F.trim(p)), lambda p: p != "")


def match_function(expression, rules: Sequence[tuple[str, str, str]] = tuple(FUNCTION_RULES)) -> Column:
    """The first rule a loader expression fits, as struct(function, params); null for none."""
    text = F.upper(F.trim(F.col(expression) if isinstance(expression, str) else expression))
    result = None
    for pattern, function, search in rules:
        hit = F.struct(F.lit(function).alias("function"), _params(text, pattern, search).alias("params"))
        branch = (text.rlike(pattern), hit)
        result = F.when(*branch) if result is None else result.when(*branch)
    return result


def required_literal(pattern: str) -> str:
    """Capitals that every match begins with behind blanks; empty where that is not certain."""
    import re

    depth = 0
    for mark in re.findall(r"\\.|\[(?:\\.|[^\]])*\]|[()|]", pattern):
        depth += {"(": 1, ")": -1}.get(mark, 0)
        if mark == "|" and depth == 0:
            return ""
    # blanks may come first, and one group may be open if nothing in it is an alternative
    lead = re.match(r"(?:\\s[*+]\??)*(?P<open>\(\?:)?(?:\\s[*+]\??)*(?P<word>[A-Z_]{3,})(?![?*{])", pattern)
    if lead is None or (lead["open"] and re.match(r"(?:\\.|\[(?:\\.|[^\]])*\]|\((?:\\.|[^()])*\)|[^()|\\])*\)[^?*{]", pattern[lead.end() :]) is None):
        return ""
    return lead["word"]


RULES = "place int, pattern string, function string, search string, groups int, gram string, literal string"


def rule_table(rules: DataFrame) -> DataFrame:
    """``RULES`` of a table of ``place, pattern, function, search``: each rule is filed under the first
    letters of its required literal, or under none if it has none. ``literal`` has up to ``LITERAL`` of them."""
    import re

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = batch.column(1).to_pylist()
            groups = pa.array([re.compile(p).groups for p in patterns], pa.int32())
            words = [required_literal(p)[:LITERAL] for p in patterns]
            grams, literals = pa.array([w[:GRAM] for w in words], pa.string()), pa.array(words, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, groups, grams, literals], names=[c.split()[0] for c in RULES.split(", ")])

    plain = rules.select(F.col("place").cast("int").alias("place"), "pattern", "function", "search")
    return plain.mapInArrow(filed, RULES)


def match_rules(expressions: DataFrame, keys: Sequence[str], expression: str, rules: DataFrame) -> DataFrame:
    """``keys``, ``function`` and ``params`` of the first rule each expression fits; null for none.

    ``rules`` as in ``rule_table``. A rule whose literal has letters that stand together in no expression is
    left out first. An expression meets the others only by their whole literals, in an equality join,
    and only those run their pattern; so rules cost no more than the few that can fit, however many
    there are and however many begin alike. Rules without a literal meet every expression. ``keys``
    tell the expressions apart.
    """
    text = F.upper(F.trim(F.col(expression)))
    rows = expressions.select(*keys, text.alias("_text"))
    kept = _possible(rows.select(_tails("_text").alias("_tails")), rules)
    filed, plain = kept.where(F.length("literal") > 0), kept.where(F.length("literal") == 0)
    # one row per leading letters and length of a literal
    shapes = filed.select("gram", F.length("literal").alias("_size")).distinct()
    tails = rows.select(*keys, "_text", F.explode(_tails("_text")).alias("_tail")).withColumn("gram", F.substring("_tail", 1, GRAM))
    words = tails.join(shapes.hint("broadcast"), "gram").where(F.col("_size") <= F.length("_tail"))
    words = words.select(*keys, "_text", F.substring(F.col("_tail"), F.lit(1), F.col("_size")).alias("literal"))
    every = rows.withColumn("literal", F.substring("_text", 1, 0))
    met = _meeting(words, filed).unionByName(_meeting(every, plain)).where(F.regexp_like("_text", F.col("pattern")))

    def group(g: Column, function: str) -> Column:
        return F.call_function(function, F.col("_text"), F.col("pattern"), g)

    numbers = F.when(F.col("groups") > 0, F.sequence(F.lit(1), F.greatest("groups", F.lit(1)))).otherwise(F.array().cast("array<int>"))
    every = F.transform(numbers, lambda g: group(g, "regexp_extract_all"))
    places = F.sequence(F.lit(0), F.greatest(F.size(F.get(every, F.lit(0))) - 1, F.lit(0)))
    by_match = F.flatten(F.transform(places, lambda j: F.transform(every, lambda of_group: F.get(of_group, j))))
    params = F.when(F.col("search") == "single", F.transform(numbers, lambda g: group(g, "regexp_extract"))).otherwise(by_match)
    found = F.filter(F.transform(params, lambda p: F.trim(p)), lambda p: p != "")
    hits = met.select(*keys, "place", F.struct("function", found.alias("params")).alias("_hit"), F.lit(0).alias("_row"))
    # expressions and hits are put together by one shuffle; an expression without a hit stays
    both = rows.select(*keys, F.lit(1).alias("_row")).unionByName(hits, allowMissingColumns=True)
    first = both.groupBy(*keys).agg(F.min_by("_hit", "place").alias("_hit"), F.sum("_row").cast("int").alias("_rows"))
    return first.withColumn("_row", F.explode(F.array_repeat(F.lit(0), F.col("_rows")))).select(*keys, "_hit.function", "_hit.params")


def _tails(text: str) -> Column:
    """What stands from each letter of a run of capitals on, up to ``LITERAL`` letters: any literal begins one of these."""
    runs = F.regexp_extract_all(text, F.lit(f"[A-Z_]{{{GRAM},}}"), F.lit(0))
    starts = lambda run: F.sequence(F.lit(1), F.length(run) - (GRAM - 1))
    return F.array_distinct(F.flatten(F.transform(runs, lambda run: F.transform(starts(run), lambda i: F.substring(run, i, F.lit(LITERAL))))))


def _possible(tails: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules whose literal is made of letters that stand together in some expression, written once."""
    found = tails.select(F.explode("_tails").alias("_tail")).select(F.substring("_tail", 1, GRAM).alias("gram")).distinct()
    grams = [r["gram"] for r in found.collect()]  # bound: 27 ** GRAM
    starts = F.sequence(F.lit(1), F.greatest(F.length("literal") - (GRAM - 1), F.lit(1)))
    strange = F.exists(starts, lambda i: ~F.substring(F.col("literal"), i, F.lit(GRAM)).isin(grams))
    return saved(rules.where((F.col("literal") == "") | ~strange), "rules")


def _meeting(words: DataFrame, rules: DataFrame) -> DataFrame:
    """Join on the literal. Which side is sent is told by the rules' number: sizes after an explode are guesses."""
    how = "broadcast" if rules.limit(SENT_RULES + 1).count() <= SENT_RULES else "merge"
    return words.join(rules.hint(how), "literal")


def drop_null_targets(columns, values) -> Column:
    """Column and value pairs of an INSERT without those whose value is the literal NULL."""
    pairs = F.arrays_zip(F.col(columns).alias("column"), F.col(values).alias("value"))
    return F.filter(pairs, lambda p: p["value"] != "NULL")
