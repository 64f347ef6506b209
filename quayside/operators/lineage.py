"""Column lineage: edges, names, the walk upstream, and the tree of systems."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.session import saved, scratch_path

PATH = ("system", "database", "table", "column")
# Steps of a walk that are taken one by one, and ways per edge that are made to take more at once.
SINGLE_STEPS, MOST_WAYS = 6, 8


def fqdn(*parts, catalog=None) -> Column:
    """Dotted name of its parts; a null part, such as a missing catalog, is left out."""
    given = [catalog] if catalog is not None else []
    return F.concat_ws(".", *[F.col(p) if isinstance(p, str) else p for p in [*given, *parts]])


def column_edges(columns: DataFrame, audit_prefix: str = "audit_") -> DataFrame:
    """One edge per target column: from its source column, or with the expression it is derived by.

    ``columns``: target and source schema, table and column, node type and expression.
    """
    own = columns.where(~F.startswith(F.lower("target_column"), F.lit(audit_prefix)))
    copied = F.upper("node_type") == "SOURCE_TABLE"
    return own.select(
        F.when(copied, fqdn("source_schema", "source_table", "source_column")).alias("src"),
        fqdn("target_schema", "target_table", "target_column").alias("trg"),
        F.when(~copied, F.concat_ws(":", "node_type", "expression")).alias("derived_by"),
    )


class _Walk:
    """Nodes found so far with their distances, one folder per round."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.rounds = spark, scratch_path(spark, "lineage-walk"), 0

    def known(self) -> DataFrame:
        return self.spark.read.parquet(self.base).select("node", "distance")

    def keep(self, nodes: DataFrame) -> int:
        """Write those that are not known yet, and say how many they were."""
        if self.rounds:
            nodes = nodes.join(self.known().select("node"), "node", "left_anti")
        seen = Observation()
        counted = nodes.select("node", F.col("distance").cast("int")).observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.parquet(f"{self.base}/round={self.rounds}")
        self.rounds += 1
        return seen.get["n"]


def _doubled(ways: DataFrame, most: int) -> DataFrame | None:
    """Ways of twice as many steps, or nothing if putting ways end to end makes more than ``most``."""
    into = ways.groupBy(F.col("trg").alias("_mid")).agg(F.count("*").alias("_into"))
    ends = ways.groupBy(F.col("src").alias("mid")).agg(F.count("*").alias("n")).join(into, F.col("mid") == F.col("_mid"))
    if (ends.agg(F.sum(F.col("n") * F.col("_into"))).head()[0] or 0) > most:
        return None
    first, second = ways.select(F.col("src").alias("mid"), "trg"), ways.select("src", F.col("trg").alias("_mid"))
    return saved(first.join(second, F.col("mid") == F.col("_mid")).select("src", "trg").distinct(), "lineage-ways")


def upstream(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """All nodes found by walking edges (``src`` feeds ``trg``) upstream from ``starts`` (``node``).

    Each node comes once with its least distance, so cycles end. The first steps join only the nodes
    new in the step before. A walk that is not over after ``SINGLE_STEPS`` goes on by doubling: ways
    of w steps, put end to end, are ways of 2w. If all nodes up to distance d are known, ways of
    w <= d + 1 steps from the outermost w layers find those up to d + w, each by its shortest walk,
    and if they find none, none is left. So a chain of n nodes takes about log2(n) rounds. Ways are
    pairs of nodes and may be many more than the edges: if there would be over ``MOST_WAYS`` times
    as many, they are not doubled further and the walk goes on at their width. Every round is written
    to the shared folder, which cuts the lineage and lets a lost executor be replaced without walking
    again.
    """
    links = saved(edges.select("src", "trg").where("src IS NOT NULL").distinct(), "lineage-edges")
    walk, distance, ways, width, most = _Walk(edges.sparkSession), 0, links, 1, None
    found = walk.keep(starts.select("node").distinct().withColumn("distance", F.lit(0)))
    while found:
        if distance + 1 >= SINGLE_STEPS:
            most = MOST_WAYS * links.count() if most is None else most
            while most and 2 * width <= distance + 1:
                doubled = _doubled(ways, most)
                if doubled is None:
                    most = 0
                else:
                    ways, width = doubled, 2 * width
        outermost = walk.known().where(F.col("distance") > distance - width)
        reached = ways.join(outermost, F.col("trg") == F.col("node"))
        found = walk.keep(reached.groupBy(F.col("src").alias("node")).agg((F.min("distance") + width).alias("distance")))
        distance += width
    return walk.known()


def tree_nodes(paths: DataFrame, levels: Sequence[str] = PATH) -> DataFrame:
    """The tree of paths as rows: name, kind, path, parent path and number of children.

    Each level is counted from the level below it, so the work shrinks going up and no node has to
    hold its whole subtree. The count looks at the children's own counts: that keeps the levels a
    chain whose shuffles are shared, where a plain count would be planned as a new scan per level.
    """
    levels = list(levels)
    below = paths.groupBy(*levels).agg((F.count(F.lit(1)) * 0).alias("children"))
    rows = None
    for depth in range(len(levels), 0, -1):
        here = levels[:depth]
        parent = F.concat_ws("/", *here[:-1]) if depth > 1 else F.lit(None).cast("string")
        level = below.select(
            F.lit(here[-1]).alias("kind"), F.col(here[-1]).alias("name"),
            F.concat_ws("/", *here).alias("path"), parent.alias("parent"), "children")
        rows = level if rows is None else rows.unionByName(level)
        if depth > 1:
            below = below.groupBy(*here[:-1]).agg(F.count_if(F.col("children") >= 0).alias("children"))
    return rows
