"""Connected components of a table of links, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import saved

MAX_ROUNDS = 60


def _lowest(pairs: DataFrame, label: str) -> DataFrame:
    """``_a, low``: the smallest of each ``a`` and its ``b``. Written, so that the join after it
    shuffles both its sides itself and may split a hot ``a``."""
    low = pairs.groupBy("a").agg(F.min("b").alias("_b"))
    return saved(low.select(F.col("a").alias("_a"), F.least("a", "_b").alias("low")), label)


def _large_star(state: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of every vertex on its smallest neighbour."""
    ways = state.select("a", "b").unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(ways, "large-low")
    hung = ways.where("b > a").join(low, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return saved(hung.unionByName(state.where("a = b")).distinct(), "large-star")


def _small_star(state: DataFrame) -> DataFrame:
    """Hangs every vertex and its smaller neighbours on the smallest of them."""
    down = state.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _lowest(down, "small-low")
    hung = down.join(low, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = low.select(F.col("_a").alias("a"), F.col("low").alias("b"))
    return saved(hung.unionByName(own).distinct(), "small-star")


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` of all vertices of ``links`` (``a, b``, of one ordered type).

    ``root`` is the smallest vertex of the component. Large-star and small-star steps alternate
    until nothing changes; a component of n vertices ends as a star after about log(n) squared of
    them. Neighbours are never gathered: the smallest is an aggregate that combines before the
    shuffle, and hanging them on it is a join, which splits a hot vertex. Every step is written to
    the shared folder. A link of a vertex to itself makes it a vertex without others; links with a
    null end must be left out.
    """
    state, before = saved(links.select("a", "b").distinct(), "links"), None
    for _ in range(MAX_ROUNDS):
        state = _small_star(_large_star(state))
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if mark == before:
            return state.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("root"))
        before = mark
    raise ValueError("components did not settle")
