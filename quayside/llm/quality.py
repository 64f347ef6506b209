"""Quality rules: counts that fail a text outright, and a likelihood ratio of hashed n-grams.

Words and word pairs are hashed to a fixed number of buckets. Two multinomials over the buckets
are counted, one of a trusted target and one of the raw corpus, and every document gets the mean
log ratio of its n-grams under the two. The same threshold holds for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
BUCKETS = 1 << 16
# Trusted ids that may be sent to every executor; more are joined by a shuffle.
BROADCAST_IDS = 500_000
# Mean log ratio from which on a text is kept.
THRESHOLD = -0.2
REPEAT_WINDOW = 8


def words_of(text: Column) -> Column:
    """The runs outside space and x09-x0D, in order; none in a null text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK))


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` on; the last ``step`` have no partner."""
    return F.zip_with(hashes, F.slice(hashes, step + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def _with_grams(df: DataFrame) -> DataFrame:
    """Adds ``_h1`` and ``_h2``, the hashes of words and of word pairs, from ``_words``."""
    df = df.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("_p2", _pairs(F.col("_h1"), 1))
    return df.withColumn("_h2", F.slice("_p2", 1, F.greatest(F.size("_p2") - 1, F.lit(0))))


def _bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def bucket_counts(docs: DataFrame, trusted_ids: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``bucket, raw, target``: how many n-grams of the corpus and of the target fall into each.

    ``trusted_ids`` has one column of ids. All documents are counted for the corpus, those of all
    trusted ids for the target. Every bucket is there and starts at one.
    """
    ids = trusted_ids.toDF("_trusted").where("_trusted is not null").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    flagged = texts.join(ids, F.col("_id") == F.col("_trusted"), "left")
    grams = _with_grams(flagged.select(F.col("_trusted").isNotNull().cast("int").alias("_flag"), words_of(F.col("_text")).alias("_words")))
    each = grams.select("_flag", F.explode(F.concat("_h1", "_h2")).alias("_gram"))
    counts = each.groupBy(_bucket(F.col("_gram")).alias("bucket")).agg(F.count("*").alias("raw"), F.sum("_flag").alias("target"))
    whole = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return whole.join(counts, "bucket", "left").select(
        "bucket", (F.coalesce("raw", F.lit(0)) + 1.0).alias("raw"), (F.coalesce("target", F.lit(0)) + 1.0).alias("target")
    )


def log_ratios(counts: DataFrame) -> DataFrame:
    """``bucket, ratio``: the log of target over corpus share, one row per bucket."""
    everything = Window.partitionBy(F.lit(0))
    shift = F.log(F.sum("raw").over(everything)) - F.log(F.sum("target").over(everything))
    return counts.select("bucket", (F.log("target") - F.log("raw") + shift).alias("ratio"))


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 8-word windows that the text holds twice or more."""
    df = df.withColumn("_p4", _pairs(F.col("_p2"), 2)).withColumn("_p8", _pairs(F.col("_p4"), 4))
    df = df.withColumn("_w8", F.slice("_p8", 1, F.greatest(F.size("_p8") - (REPEAT_WINDOW - 1), F.lit(0))))
    any_twice = F.size(F.array_distinct("_w8")) < F.size("_w8")
    placed = F.sort_array(F.transform("_w8", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("_placed", F.when(any_twice, placed))

    def twice(s: Column, i: Column) -> Column:
        return F.coalesce(s["g"] == F.get(F.col("_placed"), i - 1)["g"], F.lit(False)) | F.coalesce(s["g"] == F.get(F.col("_placed"), i + 1)["g"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("_placed", twice), lambda s: s["i"]))
    df = df.withColumn("_starts", F.when(F.col("_placed").isNotNull(), starts))
    reach = F.zip_with("_starts", F.slice("_starts", 2, F.size("_starts")), lambda a, b: F.least(F.lit(REPEAT_WINDOW), F.coalesce(b - a, F.lit(REPEAT_WINDOW))))
    total = F.aggregate(reach, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


def quality_report(
    docs: DataFrame,
    trusted_ids: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``id_col``, the base counts, ``base_failed``, ``llr`` and ``kept``.

    ``llr`` is the mean log ratio over all words and word pairs of the text, 0 for a text without
    words. A null text has no words and so fails; a null id is kept and never trusted; repeated
    rows are judged alike; without trusted rows the target is uniform. An empty table gives no
    rows. Other columns are not read.
    """
    ratios = log_ratios(bucket_counts(docs, trusted_ids, id_col=id_col, text_col=text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), words_of(F.col(text_col)).alias("_words"))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    df = df.withColumn("_lines", lines).select(
        "_id", "_words", F.xxhash64("_text").alias("_h"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    df = _repeated_words(_with_grams(df))
    grams = df.select("_id", "_h", *base, F.explode_outer(F.concat("_h1", "_h2")).alias("_gram"))
    # a fixed number of buckets, so the ratios may be sent to every executor
    scored = grams.join(F.broadcast(ratios), _bucket(F.col("_gram")) == F.col("bucket"), "left")
    # rows alike in all of this become one; how many there were follows from the number of n-grams
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    per = scored.groupBy("_id", "_h", *base).agg(F.avg("ratio").alias("llr"), F.count("*").alias("_rows"))
    per = per.withColumn("llr", F.coalesce("llr", F.lit(0.0))).withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    )
    return per.withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_rows") / n_grams).cast("int")))).select(
        F.col("_id").alias(id_col), *base, "base_failed", "llr",
        (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"),
    )
