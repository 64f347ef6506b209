"""Hard negatives by inner product, searched with length buckets and sorted coordinate lists.

All rows are dealt by length into blocks, longest first, and anchors meet every block in which
something may be found for them: blocks that hold their label when positives are looked for, blocks
long enough for the lowest score in question when negatives are. Within a block, runs of rows of
about equal length keep a sorted list of values for each coordinate of their directions. If a score
of at least ``t`` is wanted, the cosine with the anchor must be at least ``t`` over the product of the
anchor's and the run's greatest length. That leaves a range of feasible values in each coordinate;
those rows that lie in the range in all focus coordinates, the anchor's largest, are the candidates,
and only their inner products are computed, in whole numbers. As results come in, ``t`` rises to the
least score that can still enter them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import saved

# Rows of a block and anchors that meet it in one go, on average; rows with lists of their own.
BLOCK = 4096
ANCHORS = 2048
RUN = 512
# Coordinates whose feasible ranges are intersected.
FOCUS = 6
EPS = 1e-9
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative's score is between these percentages of the positive's.
LOW, HIGH = 50, 95


class Lists:
    """Rows by falling length, in runs with sorted coordinate lists."""

    def __init__(self, values: np.ndarray):
        length = np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))
        self.order = np.argsort(-length, kind="stable")
        self.rows = values[self.order]
        # sums of products below 2**53 are exact in floating point
        self.most = float(np.abs(values).max(initial=0)) * max(1, values.shape[1])
        self.fast = self.rows.astype(np.float64)
        self.runs = []
        for start in range(0, len(values), RUN):
            part, size = self.fast[start : start + RUN], length[self.order[start : start + RUN]]
            unit = part / np.where(size > 0, size, 1)[:, None]
            by_value = np.argsort(unit, axis=0, kind="stable")
            self.runs.append((start, float(size[0]), by_value, np.take_along_axis(unit, by_value, axis=0)))

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(q).max(initial=0)) < 1 << 53:
            return (self.fast[at] @ q.astype(np.float64)).astype(np.int64)
        return self.rows[at] @ q

    def candidates(self, q: np.ndarray, least) -> Iterator[np.ndarray]:
        """Places (in ``order``) of rows that may score ``least()`` or more, run by run."""
        size = math.sqrt(float((q.astype(np.float64) ** 2).sum()))
        unit = q / size if size else q.astype(np.float64)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        for start, longest, by_value, values in self.runs:
            wanted, n = least(), len(by_value)
            reach = size * longest
            if wanted <= 0:
                yield np.arange(start, start + n)
                continue
            if wanted > reach * (1 + EPS):
                return
            t = min(1.0, wanted / reach)
            spread = math.sqrt(max(0.0, 1 - t * t))
            met, lists = np.zeros(n, dtype=np.int8), 0
            for f in focus.tolist():
                x = unit[f]
                off = spread * math.sqrt(max(0.0, 1 - x * x))
                low = -1.0 if x < -t else x * t - off
                high = 1.0 if x > t else x * t + off
                a, b = np.searchsorted(values[:, f], [low - EPS, high + EPS])
                if b - a < n:
                    met[by_value[a:b, f]] += 1
                    lists += 1
            yield start + np.flatnonzero(met == lists)


def _best(score: np.ndarray, id_: np.ndarray, mark: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((mark, id_, -score))[:k]


class _Top:
    """The best ``k`` of what was offered: higher scores first, ties by smaller id."""

    def __init__(self, k: int):
        self.k, none = k, np.zeros(0, dtype=np.int64)
        self.score, self.id, self.mark = none, none, none

    def offer(self, score: np.ndarray, id_: np.ndarray, mark: np.ndarray) -> None:
        score, id_, mark = np.r_[self.score, score], np.r_[self.id, id_], np.r_[self.mark, mark]
        best = _best(score, id_, mark, self.k)
        self.score, self.id, self.mark = score[best], id_[best], mark[best]

    def least(self, low: float) -> float:
        """The least score that may still enter, ties included."""
        return float(self.score[-1]) if len(self.score) == self.k else low


def _matrices(t: pa.Table, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by dimension: which they are, and their values."""
    lists = t.column(column).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    sizes = np.asarray(lists.value_lengths()) if len(lists) else np.zeros(0, dtype=np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield at, np.asarray(lists.take(pa.array(at)).flatten(), dtype=np.int64).reshape(len(at), size)


def _columns(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(n).to_numpy() for n in names]


FOUND = "anchor_id long, anchor_mark long, rank int, positive_id long, positive_score long, id long, mark long, score long"


def _found(rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    kinds = {"int": pa.int32(), "long": pa.int64()}
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _positives_in_block(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        id_, mark, label = _columns(rows, "id", "mark", "label")
        a_id, a_mark, a_label = _columns(anchors, "id", "mark", "label")
        by_size = {m.shape[1]: (at, m) for at, m in _matrices(rows, "values")}
        out = []
        for at, queries in _matrices(anchors, "values"):
            places, values = by_size.get(queries.shape[1], (np.zeros(0, dtype=np.int64), None))
            for one in np.unique(a_label[at]).tolist():
                inside = places[label[places] == one]
                if not len(inside):
                    continue
                lists = Lists(values[label[places] == one])
                inside = inside[lists.order]
                for i, q in zip(at[a_label[at] == one].tolist(), queries[a_label[at] == one], strict=True):
                    top = _Top(k)
                    for c in lists.candidates(q, lambda top=top: top.least(-math.inf)):
                        other = c[(id_[inside[c]] != a_id[i]) | (mark[inside[c]] != a_mark[i])]
                        top.offer(lists.scores(other, q), id_[inside[other]], mark[inside[other]])
                    out += [(a_id[i], a_mark[i], 0, 0, 0, *x) for x in zip(top.id.tolist(), top.mark.tolist(), top.score.tolist(), strict=True)]
        return _found(out)

    return run


def _negatives_in_block(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        id_, mark, label = _columns(rows, "id", "mark", "label")
        a_id, a_mark, a_label = _columns(anchors, "id", "mark", "label")
        positives = anchors.column("positives").to_pylist()
        by_size = {m.shape[1]: (at, Lists(m)) for at, m in _matrices(rows, "values")}
        out = []
        for at, queries in _matrices(anchors, "values"):
            if queries.shape[1] not in by_size:
                continue
            places, lists = by_size[queries.shape[1]]
            inside = places[lists.order]
            for i, q in zip(at.tolist(), queries, strict=True):
                tops = [(p, _Top(k)) for p in positives[i] if p["score"] >= 0]

                def least(tops=tops) -> float:
                    return min((top.least(-(-low * p["score"] // 100)) for p, top in tops), default=math.inf)

                for c in lists.candidates(q, least):
                    c = c[label[inside[c]] != a_label[i]]
                    score = lists.scores(c, q)
                    for p, top in tops:
                        fits = (low * p["score"] <= 100 * score) & (100 * score <= high * p["score"]) & (score >= top.least(-math.inf))
                        if fits.any():
                            f = inside[c[fits]]
                            top.offer(score[fits], id_[f], mark[f])
                for p, top in tops:
                    named = a_id[i], a_mark[i], p["rank"], p["id"], p["score"]
                    out += [(*named, *x) for x in zip(top.id.tolist(), top.mark.tolist(), top.score.tolist(), strict=True)]
        return _found(out)

    return run


def scaled(df: DataFrame, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, mark, label, values, size, length`` of the rows that take part, equal rows once.

    ``values`` are ``floor(scale * x)`` as whole numbers, ``mark`` a hash of label and values, which
    tells rows of one id apart.
    """
    x = F.col("_vector")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(vector_col, lambda v: v.cast("double")).alias("_vector"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    rows = rows.select("id", "label", F.transform(x, lambda v: F.floor(v * float(scale)).cast("long")).alias("values")).distinct()
    squares = F.aggregate("values", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return rows.select("id", F.xxhash64("label", "values").alias("mark"), "label", "values", F.size("values").alias("size"), F.sqrt(squares).alias("length"))


def _met(index: DataFrame, groups: int, anchors: DataFrame, run) -> DataFrame:
    """Anchors (each with a ``block``) beside the rows of their blocks, so many at a time."""
    group = F.pmod(F.xxhash64("id", "mark"), F.lit(groups)).cast("int")
    each = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "id", "mark", "label", "values")
    asked = anchors.withColumn("to_group", group).withColumnRenamed("block", "to_block")
    # names of their own, since both sides come from the same rows
    asked = asked.select(*[F.col(c).alias(f"a_{c}") for c in asked.columns]).toDF(*asked.columns)
    return each.groupBy("block", "group").cogroup(asked.groupBy("to_block", "to_group")).applyInArrow(run, FOUND)


def hard_negatives(
    df: DataFrame, anchor, *, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """For each anchor and each of its positives the first negatives:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on ``id``. Vectors become ``floor(scale * x)``; a score is their integer
    inner product (64 bits) with the anchor's, higher ones come first, ties by smaller id. Positives
    are the first ``positives`` other rows of the anchor's label, negatives the first of those rows of
    other labels whose score is ``low`` to ``high`` percent of the positive's; so a positive below
    zero has none. Rows with a null id or label, a null vector, or a null or non-finite component take
    no part. Rows equal in id, label and values are one row; others that share an id are rows each.
    Vectors of different dimensions never meet; an empty vector scores 0. The result is exact.
    """
    rows = saved(scaled(df, id_col=id_col, label_col=label_col, vector_col=vector_col, scale=scale), "vectors")
    blocks = max(1, -(-rows.count() // BLOCK))
    # longest first; the hash spreads rows of one length over blocks
    by_length = rows.repartitionByRange(blocks, "size", F.col("length").desc(), F.xxhash64("id", "mark"))
    index = saved(by_length.withColumn("block", F.spark_partition_id()), "blocks")
    anchors = saved(index.where(anchor).drop("block"), "anchors")
    groups = max(1, -(-anchors.count() // ANCHORS))

    holds = index.select("block", F.col("label").alias("_label"), F.col("size").alias("_size")).distinct()
    sent = anchors.join(holds, (F.col("label") == F.col("_label")) & (F.col("size") == F.col("_size")))
    near = _met(index, groups, sent.select("block", "id", "mark", "label", "values"), _positives_in_block(positives))
    own = ["anchor_id", "anchor_mark"]
    order = [F.col("score").desc(), "id", "mark"]
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy(*own).orderBy(*order))).where(F.col("rank") <= positives)
    # no more than that many for each anchor
    known = near.groupBy(*own).agg(F.collect_list(F.struct("rank", "id", "score")).alias("positives"), F.min(F.when(F.col("score") >= 0, F.col("score"))).alias("least"))
    known = saved(known.where("least is not null"), "positives")

    asked = anchors.join(known, (F.col("id") == F.col("anchor_id")) & (F.col("mark") == F.col("anchor_mark")))
    reach = index.groupBy("block").agg(F.max("length").alias("longest")).select(F.col("block").alias("_block"), "longest")
    last = index.agg(F.max("block")).head()[0] or 0
    every = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last)))).join(reach, F.col("block") == F.col("_block"))
    long_enough = every.where(F.lit(float(low)) / 100 * F.col("least") <= F.col("length") * F.col("longest") * (1 + EPS))
    sent = long_enough.select("block", "id", "mark", "label", "values", "positives")
    found = _met(index, groups, sent, _negatives_in_block(negatives, low, high)).withColumnRenamed("rank", "place")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*own, "place").orderBy(*order))).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
