"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies. Its whole part is taken as it
is; the fractions are rounded against each other: two units meet, mass moves at random from one to
the other until one of them is 0 or 1, and the other goes on. Blocks of units do this side by side;
what each block leaves open meets again one level up, so the sum of copies of a source is kept to
within one and no task ever holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import saved

WORD = r"[^\x20\x09-\x0D]+"
# Units that one block rounds on average; the work of a block grows with its square.
BLOCK = 128
# A fraction this near to 0 or 1 is taken as whole: sums of doubles do not return exactly.
WHOLE = 1e-9
MAX_LEVELS = 20
# From one level to the next so many bands become one.
BAND_STEP = 16
# Tables counted to have no more rows than this are sent to every executor.
BROADCAST_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Number of words (code points outside space and x09-x0D); a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], limit: float) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in order of code points, null last, take ``weights`` in turn and share the sum of all
    sizes by them. No target passes ``limit`` times its source's size; what is over goes to the
    others by weight. That is the level ``x`` at which ``min(limit * size, weight * x)`` sums to
    all: ordered by how early a source fills, a source is full if sharing what the fuller ones
    left gives it its limit or more. One row per source is ranked in one task, not documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    rows = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(limit))
    all_rows = Window.partitionBy(F.lit(0))
    by_fill = all_rows.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    rows = rows.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    open_level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(all_rows)
    target = F.when(F.col("full"), F.col("cap")).otherwise(open_level["level"] * F.col("weight"))
    return rows.withColumn("target", target.cast("double")).select("source", "source_size", "target")


def _chance(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its arguments."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") * F.lit(2.0**-53)


def _meet(state: Column, unit: Column, seed: int) -> Column:
    """The open unit meets the next: one of them becomes whole, the other stays open."""
    a, b = state["open"], unit
    total = a["f"] + b["f"]
    u = _chance(seed, a["key"], b["key"])
    under = total < F.lit(1.0 - WHOLE)
    # under one: the loser gets 0, the other all; else: the winner gets 1, the other the rest
    a_settles = F.when(under, u < b["f"] / F.greatest(total, F.lit(WHOLE))).otherwise(
        u < (1.0 - b["f"]) / F.greatest(2.0 - total, F.lit(WHOLE))
    )
    settled = F.when(under, 0).otherwise(1)
    rest = F.when(under, total).otherwise(total - 1.0)
    key = F.when(a_settles, a["key"]).otherwise(b["key"])
    stays = F.when(a_settles, b["key"]).otherwise(a["key"])
    done = F.struct(key.alias("key"), settled.cast("int").alias("extra"))
    return F.struct(
        F.struct(rest.alias("f"), stays.alias("key")).alias("open"),
        F.concat(state["done"], F.array(done)).alias("done"),
    )


def _round_block(units: Column, seed: int) -> Column:
    """``struct(open, done)`` of one block's units, met in their order."""
    first = F.struct(units[0]["f"].alias("f"), units[0]["key"].alias("key"))
    kind = "array<struct<key:struct<id:bigint,nth:int,size:bigint>,extra:int>>"
    start = F.struct(first.alias("open"), F.array().cast(kind).alias("done"))
    return F.aggregate(F.slice(units, 2, F.size(units)), start, lambda s, x: _meet(s, x, seed))


def _rounded(units: DataFrame, block: int, seed: int) -> DataFrame:
    """``source, d: struct(key, extra)`` of all units ``source, band, f, key``.

    Level by level, the units of a source and band are dealt to blocks by hash. Bands keep units
    of like size together, so that what one loses another of its size wins; they widen on the way
    up until a source is one block. The last open unit of a source is drawn on its own.
    """
    done = None
    for level in range(MAX_LEVELS):
        count = units.groupBy("source", "band").agg(F.count("*").alias("n"))
        keys = count.count()
        blocks = count.select(F.col("source").alias("_s"), F.col("band").alias("_b"), F.ceil(F.col("n") / F.lit(float(block))).cast("int").alias("blocks"))
        same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("band") == F.col("_b"))
        dealt = units.join(F.broadcast(blocks) if keys <= BROADCAST_ROWS else blocks, same).select(
            "source", "band", "f", "key",
            F.pmod(F.xxhash64(F.lit(seed + level), F.col("key")), F.col("blocks")).alias("block"),
        )
        unit = F.struct(F.col("key.size").alias("size"), F.col("key.id").alias("id"), F.col("key.nth").alias("nth"), F.col("f"), F.col("key"))
        rounded = saved(
            dealt.groupBy("source", "band", "block")
            .agg(F.array_sort(F.collect_list(unit)).alias("units"))
            .select("source", "band", _round_block(F.col("units"), seed + level).alias("r")),
            "mix-level",
        )
        settled = rounded.select("source", F.explode("r.done").alias("d"))
        done = settled if done is None else done.unionByName(settled)
        units = rounded.select(
            "source", (F.col("band") / BAND_STEP).cast("int").alias("band"), F.col("r.open.f").alias("f"), F.col("r.open.key").alias("key")
        )
        if rounded.groupBy("source").count().where("count > 1").isEmpty():
            last = F.when(_chance(seed - 1, F.col("key")) < F.col("f"), 1).otherwise(0)
            return done.unionByName(units.select("source", F.struct("key", last.cast("int").alias("extra")).alias("d")))
    raise ValueError("rounding did not come to an end")


def mix_plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    limit: float = 3.0,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """One row per document: ``id, source, nth, size, source_size, target, copies``.

    ``size`` counts words; ``copies`` is how often the mix takes the document, ``limit`` at most.
    The copies of a source add up to its expected number to within one, and its words come as near
    to ``target`` as whole documents of its sizes allow. The same input and seed give the same
    mix. Rows that share an id are told apart by ``nth`` (1, 2, ... by text); a null id or source
    is a value like any other; a null or empty text has size 0; a source without words is not
    taken. An empty table gives no rows. Other columns are not read.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"),
        word_count(text).alias("size"), F.xxhash64(text).alias("_h"),
    )
    same = Window.partitionBy("id", "source").orderBy("size", "_h")
    rows = saved(rows.withColumn("nth", F.row_number().over(same)).drop("_h"), "mix-sizes")
    targets = saved(source_targets(rows, weights, limit), "mix-targets")
    few = targets.count() <= BROADCAST_ROWS
    rows = rows.join((F.broadcast(targets) if few else targets).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + WHOLE).cast("int")
    rows = rows.withColumn("whole", whole).withColumn("f", F.greatest(ratio - whole, F.lit(0.0)))
    band = F.floor(4 * F.log2(F.col("size") + 1.0)).cast("int")
    open_rows = rows.where(F.col("f") > WHOLE)
    units = open_rows.select("source", band.alias("band"), "f", F.struct("id", "nth", "size").alias("key"))
    extra = _rounded(units, block, seed).select(
        F.col("source").alias("_s"), F.col("d.key.id").alias("_id"), F.col("d.key.nth").alias("_nth"), F.col("d.extra").alias("extra")
    )
    met = F.col("source").eqNullSafe(F.col("_s")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("nth") == F.col("_nth"))
    return rows.join(extra, met, "left").select(
        "id", "source", "nth", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"),
    )


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as ``mix_plan`` says, with its columns."""
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).where("copies > 0")
    plan = plan.select(F.col("id").alias("_mix_id"), F.col("source").alias("_mix_s"), F.col("nth").alias("_mix_n"), F.col("copies").alias("_mix_c"))
    size, mark = word_count(F.col(text_col)), F.xxhash64(F.col(text_col))
    same = Window.partitionBy(F.col(id_col).cast("long"), F.col(source_col)).orderBy(size, mark)
    rows = docs.withColumn("_mix_nth", F.row_number().over(same))
    met = F.col(id_col).cast("long").eqNullSafe(F.col("_mix_id")) & F.col(source_col).eqNullSafe(F.col("_mix_s")) & (F.col("_mix_nth") == F.col("_mix_n"))
    taken = rows.join(plan, met).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_c"))))
    return taken.select(*docs.columns)
