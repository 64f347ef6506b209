"""Toxicity scores from a factorization machine over hashed terms.

Terms are a text's words and the heads of its words, hashed to a fixed number of buckets, so that a
word never seen still has heads that were. Next to a weight, each term has a vector; the product of
two terms' vectors is what they say together beyond the sum of their weights, as an insult does next
to the name of a group.

The model is fitted on a bounded number of labelled rows. Terms are counted over those by Spark, the
ones that tell the classes apart are kept, and only these terms of the fitting rows come to the
driver, where weights and vectors are found by gradient steps. Scoring reads every whole text where
it lies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import saved

BUCKETS = 1 << 20
HEADS = (3, 4, 5, 6)
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’-–—*#_~`|/\\"
# Labelled rows that a class is fitted on, by smallest hash of their id, and terms that are kept.
FIT_ROWS = 10_000
FIT_TERMS = 4096
# A term is kept if it is in so many fitting rows and so many deviations apart between the classes.
LEAST_ROWS = 5
LEAST_DEVIATION = 5.0
FACTORS = 8
STEPS = 400
RATE = 0.05
DECAY = 2e-3
CUT = 0.7
KNOWN_WORDS = 300_000


def _buckets(word: str) -> set[int]:
    """The buckets of a word, without marks at its edges, and of its heads."""
    bare = word.strip(EDGES)
    if not bare:
        return set()
    heads = [f"{n}:{bare[:n]}" for n in HEADS if len(bare) > n]
    return {zlib.crc32(x.encode()) % BUCKETS for x in [f"w:{bare}", *heads]}


def _words(text: str) -> set[str]:
    return set(text.lower().split())


@dataclass(frozen=True)
class FactorizationMachine:
    """``terms`` (buckets, ascending) with their weights and vectors."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Chance of the label of rows of positions in ``terms``, each position at most once."""
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        at = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        return _chance(_raw(self.bias, self.weights, self.vectors, at, np.repeat(np.arange(len(rows)), sizes), len(rows))[0])


def _sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    if values.ndim == 1:
        return np.bincount(row, weights=values, minlength=n)
    return np.stack([np.bincount(row, weights=v, minlength=n) for v in values.T], axis=1)


def _raw(bias, weights, vectors, at, row, n) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of each row, and the sum of its vectors. All pairs follow from that sum."""
    v = vectors[at]
    total = _sums(v, row, n)
    pairs = 0.5 * ((total**2).sum(axis=1) - _sums((v**2).sum(axis=1), row, n))
    return bias + _sums(weights[at], row, n) + pairs, total


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40)))


def fit(terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, *, seed: int = 5) -> FactorizationMachine:
    """Weights and vectors by gradient steps on all rows at once; both classes weigh the same.

    Without terms, or with one class only, the model is a constant: the classes' share, 0 without
    rows.
    """
    n, share = len(labels), float(labels.mean()) if len(labels) else 0.0
    bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    weights, vectors = np.zeros(len(terms)), np.random.default_rng(seed).normal(0, 0.02, (len(terms), FACTORS))
    if not len(terms) or not 0 < share < 1:
        return FactorizationMachine(terms, bias, weights, np.zeros_like(vectors))
    # rows with the same terms and label, as the many without any, are one row that weighs more
    alike, weigh = np.unique(np.array([f"{int(y)}:{','.join(map(str, r.tolist()))}" for y, r in zip(labels, rows, strict=True)]), return_counts=True)
    labels = np.array([float(x.partition(":")[0]) for x in alike])
    rows = [np.array(x.partition(":")[2].split(",") if x[2:] else [], dtype=np.int64) for x in alike.tolist()]
    worth = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) * weigh / n
    sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    full = np.flatnonzero(sizes)  # rows that have terms, whose terms stand side by side
    at, begins = np.concatenate(rows), (np.cumsum(sizes) - sizes)[full]
    row = np.repeat(np.arange(len(full)), sizes[full])
    by_term = np.argsort(at, kind="stable")
    met, first = np.unique(at[by_term], return_index=True)
    bias = 0.0
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), weights, vectors)]
    for step in range(1, STEPS + 1):
        v, raw = vectors[at], np.full(len(rows), bias)
        total = np.add.reduceat(v, begins, axis=0)
        own = np.add.reduceat((v**2).sum(axis=1), begins)
        raw[full] += np.add.reduceat(weights[at], begins) + 0.5 * ((total**2).sum(axis=1) - own)
        off = (_chance(raw) - labels) * worth
        each = off[full][row]
        slope_w, slope_v = DECAY * weights / len(terms), DECAY * vectors
        slope_w[met] += np.add.reduceat(each[by_term], first)
        slope_v[met] += np.add.reduceat((each[:, None] * (total[row] - v))[by_term], first, axis=0)
        moves = []
        for (mean, square), slope in zip(state, (np.array([off.sum()]), slope_w, slope_v), strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            moves.append(RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8))
        bias, weights, vectors = bias - float(moves[0][0]), weights - moves[1], vectors - moves[2]
    return FactorizationMachine(terms, bias, weights, vectors)


def held_out(doc_id: Column) -> Column:
    """True for ids whose crc32, as text, leaves 1 by 3; labels of those are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _fitting_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """``text, label`` of at most ``rows`` distinct texts' ids of each class, none of them held out."""
    known = labels.select(F.col(id_col).alias("_i"), F.col(label_col).alias("_y")).where("_i is not null and _y is not null")
    known = known.groupBy("_i").agg(F.max("_y").alias("_y")).where(~held_out(F.col("_i")))
    picked = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_i"), "_i").limit(rows) for y in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * rows ids at most
    met = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")).join(ids, F.col("_id") == F.col("_i"))
    return saved(met.groupBy("text").agg(F.max("_y").cast("int").alias("label")), "fitting-rows")


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = FIT_ROWS,
    terms: int = FIT_TERMS,
) -> FactorizationMachine:
    """The model of ``labels`` (``id_col, label_col`` 0 or 1), from rows that are not held out.

    Fitting rows are bounded by ``rows`` per class, copies of a text count once; of several labels
    of an id the larger counts; null labels and ids count for nothing.
    """
    fitting = _fitting_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, rows=rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, label = [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set().union(*map(_buckets, _words(text)), ())
                found += own
                label += [y] * len(own)
            bucket, where = np.unique(np.array(found, dtype=np.int64), return_inverse=True)
            ones = np.bincount(where, weights=np.array(label, dtype=np.float64), minlength=len(bucket)).astype(np.int64)
            every = np.bincount(where, minlength=len(bucket))
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(ones), pa.array(every.astype(np.int64))], names=["bucket", "ones", "rows"])

    sums = {r["label"]: r["n"] for r in fitting.groupBy("label").agg(F.count("*").alias("n")).collect()}  # bound: two labels
    p, q = sums.get(1, 0), sums.get(0, 0)
    seen = fitting.mapInArrow(count, "bucket long, ones long, rows long").groupBy("bucket").agg(F.sum("ones").alias("a"), F.sum("rows").alias("r"))
    apart = F.col("a") / F.lit(float(max(p, 1))) - (F.col("r") - F.col("a")) / F.lit(float(max(q, 1)))
    pooled = F.col("r") / F.lit(float(max(p + q, 1)))
    spread = F.sqrt(pooled * F.greatest(1.0 - pooled, F.lit(1e-9)) * F.lit(1 / max(p, 1) + 1 / max(q, 1)))
    told = seen.where(F.col("r") >= LEAST_ROWS).select("bucket", F.abs(apart / spread).alias("z")).where(F.col("z") >= LEAST_DEVIATION)
    kept = np.sort(np.array([r["bucket"] for r in told.orderBy(F.desc("z"), "bucket").limit(terms).collect()], dtype=np.int64))  # bound: terms

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(kept)
        for batch in batches:
            rows_ = [reader.positions(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(rows_, pa.list_(pa.int64()))], names=["label", "at"])

    told_rows = sorted((r["label"], sorted(r["at"])) for r in fitting.mapInArrow(project, "label int, at array<long>").collect())  # bound: twice FIT_ROWS
    return fit(kept, [np.array(at, dtype=np.int64) for _, at in told_rows], np.array([y for y, _ in told_rows], dtype=np.float64))


class _Reader:
    """Positions, in ascending ``terms``, of what a text holds of them."""

    def __init__(self, terms: np.ndarray):
        self.place = {b: i for i, b in enumerate(terms.tolist())}
        self.known: dict[str, tuple[int, ...]] = {}

    def positions(self, text: str) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        words, known, place = _words(text), self.known, self.place
        found: set[int] = set()
        for word in words:
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(place[b] for b in _buckets(word) if b in place)
            if own:
                found.update(own)
        return np.array(sorted(found), dtype=np.int64)


def toxicity_scores(docs: DataFrame, model: FactorizationMachine, *, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, and ``score``, from the whole text alone.

    A null or empty text gets the score of no terms. Repeated rows each get theirs. ``docs`` must
    not have a column ``score``; the text's column is left out.
    """
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(*others, F.coalesce(text_col, F.lit("")).alias("_text"))
    schema = docs.select(*others).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model.terms)
        for batch in batches:
            found = [reader.positions(t) for t in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(model.scores(found))], names=[*others, "score"])

    return rows.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", cut: float = CUT) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``. Other columns are not read."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    scored = toxicity_scores(docs.select(id_col, text_col), model, text_col=text_col)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, model: FactorizationMachine, *, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model.terms)
        for batch in batches:
            found = [reader.positions(t or "") for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.scores(found) < cut))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)
