"""Secret spans in texts, and who owns the secrets: one owner's credential or everybody's example.

Patterns find candidates. A candidate's hash is then counted over the whole corpus by distinct
repositories and owners: a value that several owners hold is a documentation example or a test
key, one that a single owner holds may be live. That count also admits values that no keyword
announces: long mixed tokens of a single owner are reported, widely copied ones are not.

Positions come from built-in functions alone: the text is split at the matches, and the lengths of
the pieces and of the matches add up to every start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import saved

# Fixed values of the base patterns, in the order in which kinds are listed. `assign` is found by
# its whole pattern and dropped afterwards if the value is short; for the runs of `access` and
# `hex` a run that is long enough is the same as a long-enough match.
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
LEAST_VALUE = 8
# Long runs of one token that mix digits and both cases.
MIXED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = (*BASE, "mixed")
MIXED_CODE = len(BASE)


def _found(text: Column, code: int, pattern: str, group: int) -> Column:
    """Pieces of the text before each match, with the match's length and value; null without one."""
    return F.when(
        text.rlike(pattern),
        F.struct(
            F.lit(code).alias("kind"),
            F.arrays_zip(
                F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("long"),
                F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
            ).alias("pieces"),
        ),
    )


def _looks_live(value: Column) -> Column:
    """Digits and both cases, and many different characters."""
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return mixed & (F.size(F.array_distinct(F.split(value, ""))) >= 12)


def secret_spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str | None = None,
    max_owners: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: the documents' keys, and one row per span.

    ``rows`` has ``_id, _h, _owner, _repository`` for every input row; ``spans`` adds ``kind, start,
    end`` (code points, end exclusive), ``value_hash, repositories, owners, seen`` and ``verdict``:
    ``live`` for a value held by at most ``max_owners`` owners, else ``example``. Base spans are
    always there; ``mixed`` ones only if live and apart from all base spans. Without
    ``repository_col`` each document is a repository. A null or empty text has no spans; a null
    owner or id is a value like any other; rows equal in key and text have their spans once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    repository = F.col(repository_col) if repository_col else F.col(id_col)
    patterns = [*((p, 2 if k == "assign" else 0) for k, p in BASE.items()), (MIXED, 0)]
    rows = saved(
        docs.select(
            F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"),
            F.col(owner_col).alias("_owner"), repository.alias("_repository"),
            F.array_compact(F.array(*[_found(text, i, p, g) for i, (p, g) in enumerate(patterns)])).alias("found"),
        ),
        "secret-matches",
    )
    key = ["_id", "_h", "_owner", "_repository"]
    pieces = (
        rows.where(F.size("found") > 0).dropDuplicates(key)
        .select(*key, F.explode("found").alias("f"))
        .select(*key, "f.kind", F.posexplode("f.pieces").alias("at", "p"))
        .where("p.long is not null")
    )
    upto = Window.partitionBy(*key, "kind").orderBy("at")
    end = F.sum(F.col("p.gap") + F.col("p.long")).over(upto)
    placed = pieces.select(*key, "kind", (end - F.col("p.long")).alias("start"), end.alias("end"), F.col("p.value").alias("value"))
    kept = placed.where(
        ((F.col("kind") != 0) | (F.length("value") >= LEAST_VALUE)) & ((F.col("kind") != MIXED_CODE) | _looks_live(F.col("value")))
    ).select(*key, "kind", "start", "end", F.sha2("value", 256).alias("value_hash"))
    held = kept.groupBy("value_hash").agg(
        # in a struct a null is a value like any other
        F.countDistinct(F.struct("_repository")).alias("repositories"), F.countDistinct(F.struct("_owner")).alias("owners"), F.count("*").alias("seen")
    )
    judged = kept.join(held, "value_hash").withColumn("verdict", F.when(F.col("owners") <= max_owners, "live").otherwise("example"))
    around = Window.partitionBy(*key).orderBy("start", "kind")
    base = F.col("kind") < MIXED_CODE
    before = F.max(F.when(base, F.col("end"))).over(around.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(around.rowsBetween(1, Window.unboundedFollowing))
    alone = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    spans = judged.withColumn("_alone", alone).where(base | (F.col("_alone") & (F.col("verdict") == "live"))).drop("_alone")
    names = F.array(*[F.lit(k) for k in KINDS])
    return rows.drop("found"), spans.withColumn("code", F.col("kind")).withColumn("kind", F.element_at(names, F.col("kind") + 1))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts by kind, ``base_sha256``, ``spans``, and live and example spans.

    A document without spans has zeros, an empty ``spans`` and the hash of an empty text. Options
    and edge cases are those of ``secret_spans``.
    """
    rows, spans = secret_spans(docs, **options)
    key = ["_id", "_h", "_owner", "_repository"]
    told = F.concat_ws(":", "kind", "start", "end")
    ordered = F.array_sort(F.collect_list(F.struct("start", "code", told.alias("told"))))
    base = F.filter(ordered, lambda s: s["code"] < MIXED_CODE)

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: s["told"]), ",")

    def n(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    per = spans.groupBy(*key).agg(
        *[n(F.col("code") == i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(ordered).alias("spans"),
        n(F.col("verdict") == "live").alias("n_live"),
        n(F.col("verdict") == "example").alias("n_example"),
    )
    renamed = per.select(*[F.col(k).alias(f"{k}_r") for k in key], *[c for c in per.columns if c not in key])
    met = F.lit(True)
    for k in key:
        met = met & F.col(k).eqNullSafe(F.col(f"{k}_r"))
    counts = [f"n_{k}" for k in KINDS] + ["n_live", "n_example"]
    return rows.join(renamed, met, "left").select(
        "_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
