"""Benchmark passages in training texts, found through a positional index of their rarest terms.

Every benchmark item is cut into phrases of consecutive words. A phrase is looked up by its rarest
terms only: postings (term, document, position) are stored for those, each posting is moved back by
the term's offset in the phrase, and where the lists of one phrase meet the phrase may start. What
meets at one place is an exact match once the words between agree; what meets within a few words is
a match by proximity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Tables counted to have no more rows than these are sent to every executor, larger ones shuffled.
BROADCAST_TERMS = 200_000
BROADCAST_DOCUMENTS = 500_000
# Places that a task sorts, on average.
TASK_ROWS = 500_000
# No word is empty, so the end of a text can be filed under the empty term.
END = ""


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does that where all is ASCII, and faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BREAK), "")


def _sent(df: DataFrame, most: int) -> DataFrame:
    """``df``, to be sent to every executor if it is counted to be small enough."""
    return F.broadcast(df) if df.count() <= most else df


def phrases(benchmark: DataFrame, *, item_col: str, text_col: str, words: int) -> DataFrame:
    """``item, phrase, terms, pid``: each run of ``words`` words of an item; a shorter item is one run.

    ``pid`` is the hash of the phrase, by which it travels through shuffles.
    """
    cut = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(text_col)).alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (words - 1), F.lit(1)))
    runs = cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("_w", i, words))).alias("terms"))
    runs = runs.select("item", F.array_join("terms", " ").alias("phrase"), "terms")
    return runs.withColumn("pid", F.xxhash64("phrase"))


def _tokens(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns, pos, tid`` of every word, by the hash of the term, and of the end of the text."""
    each = docs.select(*columns, F.posexplode(F.concat(words_of(F.col("_text")), F.array(F.lit(END)))).alias("pos", "term"))
    return each.select(*columns, "pos", F.xxhash64("term").alias("tid"))


def rarest_terms(docs: DataFrame, runs: DataFrame, *, lists: int) -> DataFrame:
    """``pid, tid, offset, rank, n, needed`` of the ``lists`` terms of each phrase that the documents hold least.

    ``n`` is how often they hold the term, ``needed`` how many terms the phrase has here. A phrase with a term that no document has cannot occur and is left out.
    """
    placed = runs.select("pid", "terms").dropDuplicates(["pid"]).select("pid", F.posexplode("terms").alias("offset", "term"))
    placed = placed.select("pid", "offset", F.xxhash64("term").alias("tid"))
    vocabulary = _sent(placed.select("tid").distinct(), BROADCAST_TERMS)
    seen = saved(_tokens(docs).join(vocabulary, "tid").groupBy("tid").agg(F.count("*").alias("n")), "term-counts")
    ranked = placed.join(_sent(seen, BROADCAST_TERMS), "tid", "left")
    by_phrase = Window.partitionBy("pid")
    ranked = ranked.withColumn("missing", F.max(F.col("n").isNull()).over(by_phrase)).where("not missing")
    ranked = ranked.withColumn("rank", F.row_number().over(by_phrase.orderBy("n", "offset")))
    ranked = ranked.where(F.col("rank") <= lists).withColumn("needed", F.max("rank").over(by_phrase))
    return saved(ranked.select("pid", "tid", "offset", "rank", "n", "needed"), "phrase-terms")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings ``_id, _h, pos, tid`` of ``terms`` in all documents, written once.

    The end of every text is filed too, so a text's posting of ``END`` holds its number of words.
    """
    end = docs.sparkSession.range(1).select(F.xxhash64(F.lit(END)).alias("tid"))
    wanted = terms.select("tid").unionByName(end).distinct()
    return saved(_tokens(docs, "_id", "_h").join(_sent(wanted, BROADCAST_TERMS), "tid"), "postings")


def phrase_starts(postings: DataFrame, led: DataFrame, *, lists: int, slop: int) -> DataFrame:
    """``_id, _h, pid, start, exact`` where the rarest terms of a phrase meet.

    Each posting is moved back by the term's offset in the phrase. ``exact`` tells places where all
    lists of the phrase agree on the start from those where all but one, and two at least, agree to
    within ``slop`` words: whichever word was changed, the others still meet. Postings are shuffled
    by document before they meet the phrases, which then need no shuffle: there are several times as
    many places as postings. How many is known from the terms' counts, and tells the number of tasks.
    Most phrases of a document have a posting of one term alone; they leave before places are compared.
    """
    tasks = max(1, -(-(led.agg(F.sum("n")).first()[0] or 0) // TASK_ROWS))
    met = postings.repartition(tasks, "_id", "_h").join(_sent(led, BROADCAST_TERMS), "tid").select(
        "_id", "_h", "pid", "rank", "needed", (F.col("pos") - F.col("offset")).alias("start")
    )
    enough = F.greatest(F.col("needed") - 1, F.least("needed", F.lit(2)))
    phrase = Window.partitionBy("_id", "_h", "pid")
    held = F.bit_count(F.bit_or(F.expr("shiftleft(1, rank)")).over(phrase))
    met = met.withColumn("_n", held).where(F.col("_n") >= enough).drop("_n")
    places = phrase.orderBy("start")
    at, near = places.rangeBetween(0, 0), places.rangeBetween(-slop, slop)
    lists_at = sum(F.max((F.col("rank") == k).cast("int")).over(at) for k in range(1, lists + 1))
    lists_near = sum(F.max((F.col("rank") == k).cast("int")).over(near) for k in range(1, lists + 1))
    met = met.withColumn("_at", lists_at).withColumn("_near", lists_near).where(F.col("_near") >= enough)
    exact = (F.col("_at") == F.col("needed")) & (F.col("start") >= 0)
    return saved(met.select("_id", "_h", "pid", "start", exact.alias("exact")).distinct(), "phrase-starts")


def _verified(texts: DataFrame, starts: DataFrame, names: DataFrame) -> DataFrame:
    """``_id, _h, pid, start`` of the exact starts at which the text holds the phrase word by word."""
    asked = starts.join(_sent(names, BROADCAST_TERMS), "pid").groupBy("_id", "_h").agg(
        F.collect_set(F.struct("start", "pid", "phrase")).alias("_asked")
    )
    asked = saved(asked.toDF("_i", "_x", "_asked"), "phrase-questions")
    met = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_x"))
    if asked.count() <= BROADCAST_DOCUMENTS:  # then only texts with a question are shuffled
        texts = texts.join(F.broadcast(asked.select("_i", "_x")), met, "left_semi")
    held = texts.join(asked, met).select("_id", "_h", words_of(F.col("_text")).alias("_w"), "_asked")

    def agrees(place: Column) -> Column:
        size = F.size(F.split(place["phrase"], " "))
        return F.array_join(F.slice("_w", place["start"] + 1, size), " ") == place["phrase"]

    return held.select("_id", "_h", F.explode(F.filter("_asked", agrees)).alias("p")).select("_id", "_h", "p.pid", "p.start").distinct()


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    words: int = 10,
    lists: int = 3,
    slop: int = 3,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(matches, items, texts)``.

    ``matches``: ``_id, _h, phrase, start, n, exact``, one row per place; ``exact`` rows are
    verified word by word, the others are places where only the rarest terms meet, all but one of
    them, within ``slop`` words. ``items``: ``phrase, item``, which items hold a phrase. ``texts``: ``_id, _h,
    n_words`` of every row of ``docs``. ``_h`` is the hash of the document's text; rows equal in id
    and text count as one document. A null or empty text, or one without words, matches nothing on
    either side. Empty tables give no rows.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_h"), F.col(text_col).alias("_text"))
    runs = phrases(benchmark, item_col=item_col, text_col=item_text_col, words=words)
    runs = saved(runs, "phrases")
    names = runs.select("pid", "phrase").distinct()
    led = rarest_terms(texts, runs, lists=lists)
    postings = build_index(texts, led)
    starts = phrase_starts(postings, led, lists=lists, slop=slop)
    found = _verified(texts, starts.where("exact"), names).toDF("_i", "_x", "_p", "_s").withColumn("_found", F.lit(True))
    here = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_x")) & (F.col("pid") == F.col("_p")) & (F.col("start") == F.col("_s"))
    # a place whose rarest terms agree while other words do not is near
    told = starts.drop("exact").join(found, here, "left").select("_id", "_h", "pid", "start", F.coalesce("_found", F.lit(False)).alias("exact"))
    matches = saved(told.join(_sent(names, BROADCAST_TERMS), "pid").drop("pid"), "matches")
    ends = postings.where(F.col("tid") == F.xxhash64(F.lit(END))).select("_id", "_h", F.col("pos").cast("long").alias("n_words"))
    return matches.withColumn("n", F.size(F.split("phrase", " "))), runs.select("phrase", "item").distinct(), ends


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: ``_id, _h, n_words, n_hit, n_items, items_sha256, n_near, contaminated``.

    ``n_hit`` counts the words inside any exact match, ``n_items`` the items with one, ``n_near``
    the phrases that the document meets by proximity and nowhere exactly. Repeated rows each get their row, a null id is kept.
    Options and edge cases are those of ``benchmark_matches``.
    """
    matches, items, texts = benchmark_matches(docs, benchmark, **options)
    exact = matches.where("exact")
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))

    def covered(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s["end"] - F.greatest(acc["upto"], s["start"]), F.lit(0))
        return F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["hit"] + fresh).alias("hit"))

    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("hit"))
    hit = exact.groupBy("_id", "_h").agg(F.aggregate(spans, start, covered, lambda acc: acc["hit"]).alias("n_hit"))
    whose = exact.select("_id", "_h", "phrase").distinct().join(_sent(items, BROADCAST_TERMS), "phrase").groupBy("_id", "_h").agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    only = matches.groupBy("_id", "_h", "phrase").agg(F.bool_or("exact").alias("exact")).where("not exact")
    near = only.groupBy("_id", "_h").agg(F.count("*").alias("n_near"))
    per = (
        hit.unionByName(whose, allowMissingColumns=True).unionByName(near, allowMissingColumns=True)
        .groupBy(F.col("_id").alias("_i"), F.col("_h").alias("_x"))
        .agg(F.max("n_hit").alias("n_hit"), F.max("items").alias("items"), F.max("n_near").alias("n_near"))
    )
    met = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_x"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return texts.join(per, met, "left").select(
        "_id", "_h", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an exact match, with their columns."""
    matches, _, _ = benchmark_matches(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    hit = matches.where("exact").select(F.col("_id").alias("_hit_id"), F.col("_h").alias("_hit_h")).distinct()
    met = F.col(id_col).eqNullSafe(F.col("_hit_id")) & (F.xxhash64(F.col(text_col)) == F.col("_hit_h"))
    return docs.join(_sent(hit, BROADCAST_DOCUMENTS), met, "left_anti")
