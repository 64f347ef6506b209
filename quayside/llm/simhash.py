"""Near duplicates by SimHash, found with a hierarchical index over fingerprints in Gray order.

The upper nodes of the index are masked bit patterns: two fingerprints at a distance of two bits or
less agree on at least two of their four quarters, so all fingerprints with the same two quarters
hang under one node, at a difference of 0 on its mask. A node with many fingerprints hands them on
to nodes with a wider mask: what is left of the bits is cut in three, one of which must agree too.

Below a node the fingerprints are sorted by Gray rank, by which neighbours differ in few bits, and
runs of them form groups. A group's pattern is made of the bits that all its members share; the
patterns of two groups differ in at least as many bits as their members must, so whole pairs of
groups are left out as soon as that passes the limit, level by level, from wide groups to single
fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.session import saved

SEED = 42
# A node with more fingerprints than this is cut further.
NODE_MOST = 4096
# Members of a group at each level of the tree below a node.
FAN = 16
# Pairs of groups or members that are looked at in one go.
PAIR_CHUNK = 1 << 20


def _simhash(text: bytes, shingle: int) -> int:
    """Bits that are set in over half the hashes of the text's shingles, repeats counted."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        pieces = [joined]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends + 1 - sizes).tolist()
        pieces = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype="<u8", count=len(pieces))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bits), 255):  # sums of up to 255 bits fit the narrow type they are fast in
        counts += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(pieces), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``_id, _h, fp`` of every row: the fingerprint as a signed 64-bit number, ``_h`` the text's hash.

    Words are the runs outside space and x09-x0D with A-Z in lower case; a text of fewer words than
    a shingle is one shingle; a null, empty or blank text has fingerprint 0.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_h"), F.coalesce(text_col, F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            values = pa.array([_simhash(t.as_py(), shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], names=["_id", "_h", "fp"])

    return rows.mapInArrow(run, "_id long, _h long, fp long")


def _gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray code, as a signed number."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def _parts(bits: list[int], into: int) -> list[list[int]]:
    """``bits`` cut into runs of near equal length."""
    edges = [len(bits) * k // into for k in range(into + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks(distance: int) -> list[int]:
    """Masks of which any two fingerprints within ``distance`` bits agree on at least one."""
    from itertools import combinations

    parts = _parts(list(range(64)), distance + 2)
    return [_signed(a + b) for a, b in combinations(parts, 2)]


def wider_masks(mask: int, distance: int) -> list[int]:
    """The same below a mask: the open bits, more than ``distance``, are cut so that one of the parts agrees too."""
    open_bits = [b for b in range(64) if not (mask >> b) & 1]
    taken = [b for b in range(64) if (mask >> b) & 1]
    return [_signed(taken + part) for part in _parts(open_bits, distance + 1)]


def _upper_nodes(unique: DataFrame, distance: int) -> Iterator[DataFrame]:
    """``mask, value, fp`` of nodes small enough for one task, level by level."""
    def placed(rows: DataFrame, masks: Column) -> DataFrame:
        each = rows.select("fp", F.explode(masks).alias("mask"))
        return each.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))

    nodes = placed(unique, F.array(*[F.lit(m) for m in first_masks(distance)]))
    while True:
        counts = saved(nodes.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1"), "node-counts")
        # values are distinct, so 2**k of them at most share a node with k open bits; with no more
        # open bits than the distance they are all linked anyway
        cut = (F.col("n") > NODE_MOST) & (64 - F.bit_count("mask") > distance)
        named = counts.select(F.col("mask").alias("_m"), F.col("value").alias("_v"), cut.alias("_cut"))
        met = nodes.join(named, (F.col("mask") == F.col("_m")) & (F.col("value") == F.col("_v")))
        yield met.where("not _cut").select("mask", "value", "fp")
        # only masks with a node to be cut go on; there are fewer of them than such nodes
        below = [(r["_m"], wider_masks(r["_m"], distance)) for r in named.where("_cut").select("_m").distinct().collect()]  # bound: masks
        if not below:
            return
        book = F.map_from_arrays(F.array(*[F.lit(m) for m, _ in below]), F.array(*[F.array(*[F.lit(x) for x in xs]) for _, xs in below]))
        nodes = saved(placed(met.where("_cut").select("fp", F.col("mask").alias("_m")), F.element_at(book, F.col("_m"))).distinct(), "nodes")


def _group_patterns(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(bits, mask)`` of the groups of each level, from single values up to one group."""
    levels = [(values, np.full(len(values), np.uint64(0xFFFFFFFFFFFFFFFF)))]
    low = high = values
    while len(low) > 1:
        at = np.arange(0, len(low), FAN)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        levels.append((low, ~(low ^ high)))
    return levels


def near_pairs(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``i < j`` of ``values`` (in Gray order) within ``distance`` bits, in portions."""
    levels = _group_patterns(values)
    waiting = [(len(levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while waiting:
        level, a, b = waiting.pop()
        bits, mask = levels[level]
        near = np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b]) <= distance
        a, b = a[near], b[near]
        if level == 0:
            apart = a < b
            yield a[apart], b[apart]
            continue
        below = len(levels[level - 1][0])
        for at in range(0, len(a), PAIR_CHUNK // (FAN * FAN)):
            x = (a[at : at + PAIR_CHUNK // (FAN * FAN), None, None] * FAN + np.arange(FAN)[None, :, None]).astype(np.int64)
            y = (b[at : at + PAIR_CHUNK // (FAN * FAN), None, None] * FAN + np.arange(FAN)[None, None, :]).astype(np.int64)
            x, y = (z.ravel() for z in np.broadcast_arrays(x, y))
            inside = (x <= y) & (y < below)
            waiting.append((level - 1, x[inside], y[inside]))


class _Forest:
    """Which of n values hang together."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Lowers labels over the pairs until both ends of each agree."""
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            high, low = np.maximum(la[apart], lb[apart]), np.minimum(la[apart], lb[apart])
            np.minimum.at(self.label, high, low)
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def _node_links(rows: pa.Table, distance: int) -> pa.RecordBatch:
    """Links ``a, b`` of whole nodes, sorted by node and Gray rank: each value with its tree's root."""
    mask, value, fp = (rows.column(k).to_numpy() for k in range(3))
    starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
    ends = np.r_[starts[1:], len(fp)]
    bits, forest = fp.view(np.uint64), _Forest(len(fp))
    sizes = ends - starts
    node = np.repeat(np.arange(len(starts)), sizes)
    # groups of one leaf each, all nodes side by side
    small = sizes <= FAN
    for d in range(1, int(sizes[small].max(initial=0))):
        i = np.flatnonzero((node[:-d] == node[d:]) & small[node[:-d]])
        i = i[np.bitwise_count(bits[i] ^ bits[i + d]) <= distance]
        forest.join(i, i + d)
    for start, end in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
        for a, b in near_pairs(bits[start:end], distance):
            forest.join(a + start, b + start)
    linked = forest.label != np.arange(len(fp))
    return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[forest.label[linked]])], names=["a", "b"])


def fingerprint_links(unique: DataFrame, distance: int) -> DataFrame:
    """``a, b`` over distinct fingerprints ``fp``: enough links to hold together all within ``distance``.

    Every node gives a spanning forest of its links, at most one row per member.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            mask, value = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1]))
            whole = int(new[-1]) + 1 if len(new) else 0
            if whole:
                yield _node_links(rows.slice(0, whole), distance)
            rest = rows.slice(whole)
        if rest is not None and rest.num_rows:
            yield _node_links(rest, distance)

    links = None
    for nodes in _upper_nodes(unique, distance):
        sorted_nodes = nodes.repartition("mask", "value").sortWithinPartitions("mask", "value", _gray_rank(F.col("fp")))
        found = sorted_nodes.mapInArrow(run, "a long, b long")
        links = found if links is None else links.unionByName(found)
    return links


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """One row per document: ``_id, _h, fp, root, component_id``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; ``component_id`` is
    the smallest id reachable over links, the document's own included, ``root`` the smallest
    fingerprint there. Null ids count for nothing there; a group of nothing else has a null
    ``component_id``. Equal fingerprints are one vertex, so copies cost no pairs. Repeated rows each
    get their row; an empty table gives none.
    """
    if not 0 <= distance <= 6:
        raise ValueError("distance must be 0 to 6")
    prints = saved(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    unique = saved(prints.groupBy("fp").agg(F.min("_id").alias("low")), "unique-fingerprints")
    roots = components(fingerprint_links(unique.select("fp"), distance))
    named = unique.join(roots, F.col("fp") == F.col("vertex"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = saved(named, "fingerprint-roots")
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    groups = saved(named.select("fp", "root").join(least, "root"), "fingerprint-groups")
    return prints.join(groups, "fp").select("_id", "_h", "fp", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest id, null last.

    Of rows that share that id the one with the smallest text hash stays.
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    # a null id is larger than any other
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_h"))
    kept = saved(groups.groupBy("root").agg(F.min(first).alias("first")).select("first._id", "first._h"), "kept")
    kept = kept.toDF("_kept_id", "_kept_h").distinct()
    met = F.col(id_col).cast("long").eqNullSafe(F.col("_kept_id")) & (F.xxhash64(text_col) == F.col("_kept_h"))
    stays = docs.join(kept, met)
    return stays.dropDuplicates(["_kept_id", "_kept_h"]).select(*docs.columns)
