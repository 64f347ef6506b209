"""Shards of near equal size by a minimax contiguous partition of ordered atomic groups.

Equal texts form a group, and a group stays in one shard. The groups are put in one order, and the
smallest shard capacity is searched for which filling shards in that order, group by group, needs
no more shards than there are. The order is cut there.

The search runs on a summary whose size does not grow with the input: groups that weigh next to
nothing against a shard are summed into cells by the head of their hash, and only large groups are
listed one by one. Cells and large groups are the atoms of the order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import saved

# Cells of small groups, named by so many hex digits of the text's hash: 65,536.
CELL_DIGITS = 4
# A group is listed alone from this share of a shard on, so at most shards * 256 groups are.
ALONE = 256
# Rows of a stretch that one task numbers.
STRETCH = 50_000


def min_capacity(sizes: np.ndarray, shards: int) -> int:
    """The smallest capacity for which greedy filling of ``sizes``, in order, needs ``shards``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    low, high = max(int(sizes.max()), -(-total // shards)), total
    while low < high:
        mid = (low + high) // 2
        at, used = 0, 0
        while at < total and used <= shards:
            # the last end that still fits behind what is filled so far
            at = int(ends[np.searchsorted(ends, at + mid, side="right") - 1])
            used += 1
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def cut(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each atom, 0 to ``shards - 1``, in order; no shard passes the minimax capacity.

    Several cuts share that capacity. Of those that leave the rest room enough, each shard takes
    the end nearest to an even share of what is left.
    """
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    capacity, ends = min_capacity(sizes, shards), np.cumsum(sizes)
    total = int(ends[-1])
    # earliest[k]: the least that must be filled for k more shards to hold the rest
    earliest = [total]
    for _ in range(shards):
        i = np.searchsorted(ends, earliest[-1] - capacity, side="left")
        earliest.append(int(ends[i]) if earliest[-1] > capacity else 0)
    shard, at, done = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for k in range(shards):
        left = shards - k
        last = int(np.searchsorted(ends, at + capacity, side="right"))
        first = int(np.searchsorted(ends, earliest[left - 1], side="left")) + 1 if earliest[left - 1] > at else done
        near = int(np.searchsorted(ends, at + (total - at) / left, side="left"))
        if near < len(ends) and near > done and abs(ends[near - 1] - at - (total - at) / left) <= abs(ends[near] - at - (total - at) / left):
            near -= 1
        stop = min(max(near + 1, first, done), last, len(sizes))
        shard[done:stop] = k
        done, at = stop, int(ends[stop - 1]) if stop else 0
    return shard


def plan_shards(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each atom. Atoms of a mean share or more stand first and each fills a shard.

    They alone would set the capacity of all shards; with them set apart, the capacity of the rest
    is the smallest that the rest allows.
    """
    order = np.argsort(-sizes, kind="stable")
    giants = 0
    while giants < min(shards - 1, len(sizes)) and sizes[order[giants]] * (shards - giants) > sizes[order[giants:]].sum():
        giants += 1
    out = np.zeros(len(sizes), dtype=np.int64)
    out[order[:giants]] = np.arange(giants)
    rest = np.sort(order[giants:])
    out[rest] = giants + cut(sizes[rest], shards - giants)
    return out


def _size(text: Column, extra: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(extra)


def assign_shards(
    docs: DataFrame,
    shards: int = 40,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    extra_bytes: int = 16,
) -> DataFrame:
    """One row per document: ``id_col, size, text_crc32, group_hash, shard, slot``.

    ``size`` is the text's UTF-8 bytes and ``extra_bytes``. Equal texts share a shard, null texts
    too (a group apart from empty ones, with the crc of no bytes); ``slot`` numbers a shard's rows
    from 0 without gaps, by atom, then by id within stretches. Repeated rows each get a slot, a
    null id is kept and comes first. An empty table gives no rows. With fewer groups than shards
    some shards stay empty. Other columns are not read.

    Only sums cross the driver: 65,536 cells at most, and the groups above a 256th of a shard.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = saved(
        docs.select(
            F.col(id_col).alias("_id"), _size(text, extra_bytes).alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            F.coalesce(F.md5(text), F.lit("null")).alias("group_hash"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).head()[0] or 0
    groups = rows.groupBy("group_hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    cell = F.substring("group_hash", 1, CELL_DIGITS)
    alone = F.col("bytes") * (shards * ALONE) > F.lit(total)
    atom = F.when(alone, F.col("group_hash")).otherwise(cell)
    # groups that stand alone are named whole, so rows find their atom by a list of those names
    atoms = groups.groupBy(atom.alias("atom")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).orderBy("atom").collect()  # bound: cells and large groups
    shard = plan_shards(np.array([a["bytes"] for a in atoms], dtype=np.int64), shards)
    base, listed = [0] * shards, []
    for a, s in zip(atoms, shard.tolist(), strict=True):
        listed.append((a["atom"], s, base[s], a["n"]))
        base[s] += a["n"]
    book = F.broadcast(spark.createDataFrame(listed, "atom string, shard int, base long, n long"))
    single = F.broadcast(spark.createDataFrame([(a[0],) for a in listed if len(a[0]) != CELL_DIGITS], "atom string"))
    named = rows.join(single, rows["group_hash"] == single["atom"], "left")
    named = named.withColumn("atom", F.coalesce("atom", cell)).join(book, "atom")

    # a large group is numbered in stretches, so no task holds all copies of a text
    parts = F.ceil(F.col("n") / F.lit(float(STRETCH))).cast("int")
    named = named.withColumn("part", F.pmod(F.xxhash64("_id"), parts).cast("int"))
    per_part = named.groupBy("atom", "part").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("atom").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("atom", "part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("start"))
    within = Window.partitionBy("atom", "part").orderBy(F.col("_id").asc_nulls_first(), "group_hash")
    numbered = named.withColumn("at", F.row_number().over(within) - 1).join(starts, ["atom", "part"])
    return numbered.select(
        F.col("_id").alias(id_col), "size", "text_crc32", "group_hash", "shard",
        (F.col("base") + F.col("start") + F.col("at")).alias("slot"),
    )
