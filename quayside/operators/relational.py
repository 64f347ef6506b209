"""Helpers for SQL constructs that Spark tables lack, and windows that survive a hot key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Leading bits of a hash by which rows are counted before they are drawn.
DRAW_BITS = 12


def qualify(df: DataFrame, condition: str, **windows: Column) -> DataFrame:
    """Filter on window results without keeping them.

    A bound on ``row_number`` or ``rank`` is applied within each task before the shuffle.
    """
    return df.withColumns(windows).where(F.expr(condition)).drop(*windows)


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Mapping[str, str], where: str | None = None
) -> DataFrame:
    """UPDATE target SET ... FROM source: ``values`` are expressions over both, source as ``s``.

    ``source`` holds one row per key. Rows without a match, or failing ``where``, stay as they are.
    """
    hit = source.withColumn("_hit", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = target.alias("t").join(hit, on, "left")
    match = F.coalesce(F.col("s._hit"), F.lit(False))
    if where:
        match &= F.coalesce(F.expr(where), F.lit(False))
    return joined.select([
        F.when(match, F.expr(values[c])).otherwise(F.col(f"t.{c}")).alias(c) if c in values else F.col(f"t.{c}")
        for c in target.columns
    ])


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DELETE FROM target WHERE EXISTS a source row with its keys."""
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)


def duplicate_free(df: DataFrame) -> DataFrame:
    """Rows of a table that admits no duplicate rows."""
    return df.distinct()


def join_back(rows: DataFrame, found: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Join results to the rows they were made from.

    The columns are compared as one struct, in which nulls are equal, so no row is lost.
    """
    key = F.struct(*on).alias("_on")
    return rows.select("*", key).join(found.select(key, *columns), "_on").drop("_on")


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: Column, out: str
) -> DataFrame:
    """``sum(value)`` from the first row of the key up to this one.

    ``block`` cuts a key's rows into consecutive stretches of its order (say, an hour of a
    timestamp), so that no task has to hold all rows of a hot key: sums run within a block, and
    each block adds the total of the blocks before it, for which one row per block is ranked.
    Window and join share one partitioning by key and block, so rows are shuffled once. Exact for
    integers and decimals.
    """
    parts = df.withColumn("_on", F.struct(*keys, block.alias("_block")))
    totals = parts.groupBy("_on").agg(F.sum(value).alias("_amount"))
    earlier = Window.partitionBy(*[F.col(f"_on.{k}") for k in keys]).orderBy("_on._block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_on", F.sum("_amount").over(earlier).alias("_before"))
    local = Window.partitionBy("_on").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("_local", F.sum(value).over(local)).join(before, "_on")
    total = F.coalesce(F.col("_before") + F.col("_local"), "_before", "_local")
    return placed.withColumn(out, total).select(*df.columns, out)


def rank_within(df: DataFrame, keys: Sequence[str], order: str, block: Column, out: str) -> DataFrame:
    """``rank()`` of a row within its key.

    Rows with the same value share a rank, so only the counts per value are ranked, and joined
    back: neither a hot key nor a hot value gathers its rows. ``block`` is a stretch of the order
    column's values, see ``running_total``.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(counts, keys, [order], "_n", block, "_upto")
    ranks = upto.withColumn(out, (F.col("_upto") - F.col("_n") + 1).cast("long"))
    return join_back(df, ranks, [*keys, order], [out]).select(*df.columns, out)


def lookback_sum(df: DataFrame, keys: Sequence[str], at: str, value: str, seconds: int, out: str) -> DataFrame:
    """``sum(value)`` over the rows of the key in the ``seconds`` up to and including this one.

    RANGE BETWEEN interval PRECEDING AND CURRENT ROW, with each key cut into stretches as long as
    the interval. A row is needed in its own stretch and in the next, so it is sent to both.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    own = F.floor(micros / F.lit(seconds * 1_000_000))
    copies = F.explode(F.array(F.struct(own.alias("_block"), F.lit(True).alias("_own")),
                               F.struct((own + 1).alias("_block"), F.lit(False).alias("_own"))))
    placed = df.withColumns({"_at": micros, "_copy": copies}).select("*", "_copy._block", "_copy._own")
    frame = Window.partitionBy(*keys, "_block").orderBy("_at").rangeBetween(-seconds * 1_000_000, 0)
    return placed.withColumn(out, F.sum(value).over(frame)).where("_own").select(*df.columns, out)


def sample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows drawn uniformly (all, if there are fewer), the same ones for a seed however ``df`` is partitioned.

    The rows with the smallest seeded hashes are drawn. Rows are first counted by the leading bits of
    their hash; those below the bits in which the n-th falls are taken as they are, and only rows that
    share these bits are put in order. Equal rows share a hash and are drawn one by one.
    """
    bits = F.shiftrightunsigned(F.col("_draw"), 64 - DRAW_BITS)
    drawn = df.withColumn("_draw", F.xxhash64(F.lit(seed), *df.columns))
    counts = sorted(drawn.groupBy(bits.alias("b")).agg(F.count("*").alias("n")).collect())  # bound: 2**DRAW_BITS
    left = n
    for b, count in counts:
        if count >= left:
            last = drawn.where(bits == b).orderBy("_draw").limit(left)
            return drawn.where(bits < b).unionByName(last).drop("_draw")
        left -= count
    return df
