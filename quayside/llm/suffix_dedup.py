"""Repeated passages removed byte by byte, the first occurrence kept.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier, in a document with a
smaller id or further left in the same one. In suffix order, what a text position repeats stands
next to it: the longest previous factor of a position is found among the nearest entries before and
after it in suffix order that have a smaller position. Positions whose longest previous factor has
``length`` bytes or more start a string that goes.

One suffix array of the corpus would have one entry per byte. Instead, suffixes are brought together
by content. Each window of ``length`` bytes is named by its smallest hashed ``gram`` (the leftmost, if
it occurs twice), so equal windows have the same name, wherever they are. Neighbouring windows with
the same gram form a segment; two windows of one segment are never equal. Then

1. segments are named and hashed where the texts lie. Segments that repeat an earlier one of the
   same task go at once, so a passage in every document leaves a task once;
2. segments meet by gram. Those that meet no other cannot hold a repeat. Of equal ones, which stand
   next to each other in any suffix order, all but the first have it as their previous factor. Two
   that differ can share a window only if they also agree on what stands right before the gram or
   right behind it, since more than half of the window's rest lies on one side: those that agree
   with no other on either side (by 8 bits of a hash) are done with;
3. the others are fetched from the texts, and suffix order, common prefixes and previous factors are
   computed for their suffixes, gram by gram;
4. a gram with more than ``HOT`` different segments, or ``HOT_ROWS`` of any, is not gathered: its
   windows are grouped by their own bytes, which combines before the shuffle. This path keeps the
   first of each window and uses no suffix order;
5. spans are brought together by document, merged and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import saved

LENGTH = 100
GRAM = 32
# Text positions that are hashed in one go, and segments that a task compares among themselves.
CHUNK = 1 << 17
HELD = 1 << 20
# Bytes of text put together before they are hashed.
BLOCK = 1 << 22
# A gram with more different segments than this, or more of any, is cut into its windows.
HOT = 4096
HOT_ROWS = 1 << 16
# Windows whose suffix order is computed in one go, if whole grams allow it.
SUFFIXES = 1 << 18
NO_ID = -(1 << 63)

_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(24)
_LOW = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position on, put together from halves."""
    size, h = 1, _mixed((data.astype(np.uint64) + np.uint64(1)) * _STEP)
    while size * 2 <= gram:
        h = _mixed(h[:-size] * _STEP + h[size:])
        size *= 2
    if size < gram:
        h = _mixed(h[: len(data) - gram + 1] * _STEP + h[gram - size :])
    return h


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from every position on."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if n not in _POWERS:
        base = int(_STEP)
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(n, np.uint64(base)), np.full(n, np.uint64(inverse))
        up[0] = down[0] = 1
        _POWERS[n] = np.cumprod(up), np.cumprod(down)
    return _POWERS[n]


def _bits(h: np.ndarray) -> np.ndarray:
    """8 bits of a hash, never 0."""
    return ((h >> np.uint64(40)) & np.uint64(255)).astype(np.int64) | 256


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(start, n, name, mark, sides)`` of the segments of texts laid end to end, in portions.

    ``ends`` are the texts' ends. A segment is ``n`` windows from ``start`` on; ``name`` is the hash of
    its gram, ``mark`` that of all its bytes. ``sides`` has 9 bits each, from the hashes of the
    ``gram`` bytes before the gram and behind it; 0 where the segment does not reach so far.
    """
    up, down = _powers(CHUNK + length)
    for base in range(0, len(data) - length + 1, CHUNK):
        part = data[base : base + CHUNK + length - 1]
        h = _gram_hashes(part, gram)
        at = np.arange(len(h), dtype=np.uint64)
        # the smallest hash, and of equal ones the leftmost
        place = (_least((h & ~_LOW) | at, length - gram + 1) & _LOW).astype(np.int64)
        n = len(place)
        starts = np.arange(base, base + n)
        whole = starts + length <= ends[np.searchsorted(ends, starts, side="right")]
        new = np.r_[True, place[1:] != place[:-1]]
        first = np.flatnonzero(whole & (new | ~np.r_[False, whole[:-1]]))
        last = np.flatnonzero(whole & (np.r_[new[1:], True] | ~np.r_[whole[1:], False]))
        if not len(first):
            continue
        summed = np.r_[np.uint64(0), np.cumsum(_mixed(h ^ _STEP) * up[: len(h)])]
        count = last - first + 1
        grams_end = last + (length - gram) + 1
        mark = _mixed((summed[grams_end] - summed[first]) * down[first] + count.astype(np.uint64))
        at = place[first]
        left, right = at - gram, at + gram
        sides = np.where(left >= first, _bits(h[np.maximum(left, 0)]), 0)
        sides |= np.where(right + gram <= last + length, _bits(h[np.minimum(right, len(h) - 1)]) << 9, 0)
        yield first + base, count, h[at].view(np.int64), mark.view(np.int64), sides


class _Runs:
    """The members of a table sorted by name, mark and position: which repeat another, which differ."""

    def __init__(self, name, mark, id_, h, at):
        n = len(name)
        new_name = np.r_[True, name[1:] != name[:-1]][:n]
        new_mark = new_name | np.r_[True, mark[1:] != mark[:-1]][:n]
        lead = np.flatnonzero(new_mark)
        own = np.repeat(lead, np.diff(np.r_[lead, n]))
        self.first = new_mark
        # the same row once more is no repeat
        self.repeats = ~new_mark & ((id_ != id_[own]) | (h != h[own]) | (at != at[own]))
        group = np.cumsum(new_name) - 1
        self.kinds = np.bincount(group, weights=new_mark)[group].astype(np.int64) if n else np.zeros(0, dtype=np.int64)
        self.rows = np.bincount(group)[group] if n else np.zeros(0, dtype=np.int64)


MET = "kind int, name long, mark long, id long, h long, at long, n int, sides int"
SPAN = "id long, h long, start long, end long"


def _batch(columns: list[np.ndarray], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def _merged(id_: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each document that touch or overlap, as one."""
    if not len(start):
        return id_, h, start, end
    order = np.lexsort((start, h, id_))
    id_, h, start, end = id_[order], h[order], start[order], end[order]
    doc = np.cumsum(np.r_[True, (id_[1:] != id_[:-1]) | (h[1:] != h[:-1])])
    # positions of a document lie behind all those of the one before
    shift = np.int64(1) << np.int64(40)
    reach = np.maximum.accumulate(end + doc * shift)
    new = np.flatnonzero(np.r_[True, start[1:] + doc[1:] * shift > reach[:-1]])
    return id_[new], h[new], start[new], reach[np.r_[new[1:] - 1, len(start) - 1]] - doc[new] * shift


def _met(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Step 1: segments by gram (``kind`` 0), and spans that repeat one of the same task (``kind`` 1)."""

    def settled(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        name, mark, id_, h, at, n, sides = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((at, h, id_, mark, name))
        name, mark, id_, h, at, n, sides = (x[order] for x in (name, mark, id_, h, at, n, sides))
        runs = _Runs(name, mark, id_, h, at)
        f, r = runs.first, runs.repeats
        zeros = np.zeros(int(f.sum()), dtype=np.int32)
        yield _batch([zeros, name[f], mark[f], id_[f], h[f], at[f], n[f], sides[f]], MET)
        i, x, start, end = _merged(id_[r], h[r], at[r], at[r] + n[r] + (length - 1))
        # a span travels by its document's hash, with its end in the place of the mark
        zeros = np.zeros(len(i), dtype=np.int32)
        yield _batch([zeros + 1, x, end, i, x, start, zeros, zeros], MET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, hashes, texts = batch.columns[0].to_numpy(), batch.columns[1].to_numpy(), batch.columns[2]
            sizes = np.fromiter((len(t.as_buffer()) for t in texts), dtype=np.int64, count=len(texts))
            upto = np.cumsum(sizes)
            at = 0
            while at < len(sizes):
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, side="right")))
                data = np.frombuffer(b"".join(t.as_py() for t in texts[at:stop]), dtype=np.uint8)
                ends = np.cumsum(sizes[at:stop])
                begins = ends - sizes[at:stop]
                for start, n, name, mark, sides in segments(data, ends, length, gram):
                    doc = np.searchsorted(ends, start, side="right")
                    parts.append((name, mark, ids[at:stop][doc], hashes[at:stop][doc], start - begins[doc], n, sides))
                    held += len(start)
                    if held > HELD:
                        yield from settled(parts)
                        parts, held = [], 0
                at = stop
        if parts:
            yield from settled(parts)

    return docs.select("_id", "_h", F.col("_text").cast("binary")).mapInArrow(run, MET)


ASKED = "kind int, name long, id long, h long, start long, end long, hot int"


def _agreeing(name: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Which of the rows agree with another of the same name on one side."""
    found = np.zeros(len(name), dtype=bool)
    for bits in (sides & 511, sides >> 9):
        order = np.lexsort((bits, name))
        n, b = name[order], bits[order]
        same = (n[1:] == n[:-1]) & (b[1:] == b[:-1]) & (b[1:] > 0)
        found[order] |= np.r_[False, same] | np.r_[same, False]
    return found


def _resolved(met: DataFrame, length: int, gram: int) -> DataFrame:
    """Step 2: spans that repeat an equal segment (``kind`` 1), segments to be compared (``kind`` 0).

    A task holds ``HOT_ROWS`` rows of a gram; of one that has more, each row is judged as it comes,
    by the first of its equals.
    """

    def told(t: pa.Table, hot_gram: bool, known_first: bool) -> Iterator[pa.RecordBatch]:
        name, mark, id_, h, at, n, sides = (t.column(k).to_numpy() for k in range(1, 8))
        runs = _Runs(name, mark, id_, h, at)
        r = runs.repeats
        i, x, start, end = _merged(id_[r], h[r], at[r], at[r] + n[r] + (length - 1))
        zeros = np.zeros(len(i), dtype=np.int64)
        yield _batch([zeros.astype(np.int32) + 1, zeros, i, x, start, end, zeros.astype(np.int32)], ASKED)
        hot = np.full(len(name), hot_gram) | (runs.kinds > HOT)
        a = runs.first & (hot | (runs.kinds > 1))
        a[:1] &= not known_first
        if length >= 3 * gram:
            cool = np.flatnonzero(a & ~hot)
            a[cool] = _agreeing(name[cool], sides[cool])
        yield _batch([np.zeros(int(a.sum()), dtype=np.int32), name[a], id_[a], h[a], at[a], at[a] + n[a] + (length - 1), hot[a].astype(np.int32)], ASKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, lead = None, None  # rows of the last gram; of one with too many, the first of its last equals
        for batch in batches:
            spans = batch.filter(pa.array(batch.column(0).to_numpy() == 1))
            if spans.num_rows:
                _, _, end, i, x, start, n, _ = (c.to_numpy() for c in spans.columns)
                yield _batch([np.ones(len(i), dtype=np.int32), np.zeros(len(i), dtype=np.int64), i, x, start, end, n], ASKED)
            new = pa.Table.from_batches([batch.filter(pa.array(batch.column(0).to_numpy() == 0))])
            rows = new if rest is None else pa.concat_tables([rest, new])
            name = rows.column(1).to_numpy()
            cuts = np.flatnonzero(name[1:] != name[:-1])
            if lead is not None and len(name):
                # up to where the gram ends, or all
                stop = (int(cuts[0]) + 1 if len(cuts) else len(name)) if name[0] == lead.column(1)[0].as_py() else 0
                if stop:
                    yield from told(pa.concat_tables([lead, rows.slice(0, stop)]), True, True)
                    lead = _last_equals(pa.concat_tables([lead, rows.slice(0, stop)]))
                if stop < len(name):
                    lead = None
                rows, name = rows.slice(stop), name[stop:]
                cuts = np.flatnonzero(name[1:] != name[:-1])
            whole = int(cuts[-1]) + 1 if len(cuts) else 0
            if whole:
                yield from told(rows.slice(0, whole), False, False)
            rest = rows.slice(whole)
            if rest.num_rows > HOT_ROWS:
                yield from told(rest, True, False)
                rest, lead = rest.slice(0, 0), _last_equals(rest)
        if rest is not None and rest.num_rows:
            yield from told(rest, False, False)

    sorted_ = met.repartition("name").sortWithinPartitions("name", "mark", "id", "h", "at")
    return saved(sorted_.mapInArrow(run, ASKED), "repeats")


def _last_equals(rows: pa.Table) -> pa.Table:
    """The first of the rows that have the last one's mark."""
    mark = rows.column(2).to_numpy()
    return rows.slice(int(np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])[-1]), 1)


def previous_factors(order: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factor of each position, from suffix order and common prefixes.

    ``order`` has the positions in suffix order, ``common[i]`` the length shared by entries ``i - 1``
    and ``i``. The nearest entry with a smaller position is searched on either side, all at once: an
    entry whose candidate is larger goes on to that one's own candidate, since all between the two
    are larger still, and keeps the least common prefix on the way. Searches whose prefix has
    fallen below ``least`` end with 0.
    """
    n = len(order)
    best = np.zeros(n, dtype=np.int64)
    for side in (1, -1):
        position = order if side == 1 else order[::-1]
        shared = common if side == 1 else np.r_[0, common[1:][::-1]]
        candidate, prefix = np.arange(n) - 1, shared.astype(np.int64)
        prefix[:1] = 0
        open_ = np.flatnonzero(prefix >= least)
        while len(open_):
            c = candidate[open_]
            open_ = open_[position[c] > position[open_]]
            c = candidate[open_]
            step_c, step_p = candidate[c], np.minimum(prefix[open_], prefix[c])
            candidate[open_], prefix[open_] = step_c, step_p
            open_ = open_[step_p >= least]
        factor = np.where(prefix >= least, prefix, 0)
        best = np.maximum(best, factor if side == 1 else factor[::-1])
    out = np.zeros(n, dtype=np.int64)
    out[order] = best
    return out


def _factors(t: pa.Table, length: int) -> pa.RecordBatch:
    """Step 3: spans of segments ``name, id, h, start, bytes``, sorted by all but the last."""
    name, id_, h, start = (t.column(k).to_numpy() for k in range(4))
    texts = t.column(4).to_pylist()
    keep = np.r_[True, (name[1:] != name[:-1]) | (id_[1:] != id_[:-1]) | (h[1:] != h[:-1]) | (start[1:] != start[:-1])]
    n = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) - (length - 1)
    begin = np.cumsum(n + (length - 1)) - (n + (length - 1))
    keep = np.flatnonzero(keep)
    n, begin, name, id_, h, start = n[keep], begin[keep], name[keep], id_[keep], h[keep], start[keep]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    shift = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    # a text that comes as several rows may be cut otherwise in each: every place counts once
    doc = np.cumsum(np.r_[True, (name[1:] != name[:-1]) | (id_[1:] != id_[:-1]) | (h[1:] != h[:-1])])
    _, once = np.unique((doc[row] << np.int64(40)) + start[row] + shift, return_index=True)
    row, shift = row[once], shift[once]
    group = np.cumsum(np.r_[True, name[1:] != name[:-1]])[row]
    windows = np.lib.stride_tricks.sliding_window_view(data, length)[begin[row] + shift]
    # the gram's number ahead of the window keeps the suffixes of one gram together
    keyed = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), windows], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{length + 4}").ravel(), kind="stable")
    ranked = keyed[order]
    unlike = ranked[1:] != ranked[:-1]
    equal = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length + 4)
    common = np.r_[0, np.maximum(equal - 4, 0)]
    found = previous_factors(order, common, length) >= length
    r, s = row[found], shift[found]
    begins = start[r] + s
    return _batch(list(_merged(id_[r], h[r], begins, begins + length)), SPAN)


def _compared(segs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            rows = new if rest is None else pa.concat_tables([rest, new])
            name = rows.column(0).to_numpy()
            cuts = np.flatnonzero(name[1:] != name[:-1]) + 1
            # windows up to each gram's end
            sizes = np.cumsum(np.asarray(pa.compute.binary_length(rows.column(4))) - (length - 1))
            at = 0
            while len(cuts):
                done = sizes[at - 1] if at else 0
                fits = cuts[(cuts > at) & (sizes[cuts - 1] - done <= SUFFIXES)]
                later = cuts[cuts > at]
                if not len(later):
                    break
                stop = int(fits[-1] if len(fits) else later[0])
                yield _factors(rows.slice(at, stop - at), length)
                at = stop
            rest = rows.slice(at)
        if rest is not None and rest.num_rows:
            yield _factors(rest, length)

    sorted_ = segs.repartition("name").sortWithinPartitions("name", "id", "h", "start")
    return sorted_.mapInArrow(run, SPAN)


def _hot_windows(segs: DataFrame, length: int) -> DataFrame:
    """Spans of segments of hot grams: each window goes where its own bytes send it.

    The first place of a window is an aggregate that combines before the shuffle; all other places
    are found by a join that splits a hot window.
    """
    each = segs.select("id", "h", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.octet_length("bytes") - (length - 1)), lambda i: F.substring("bytes", i, length)
    )).alias("shift", "window"), "start")
    each = each.select("id", "h", (F.col("start") + F.col("shift")).alias("start"), "window")
    place = F.struct("id", "h", "start")
    first = saved(each.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "hot-windows")
    named = first.select(F.col("window").alias("_w"), "first")
    again = each.join(named, F.col("window") == F.col("_w")).where(place != F.col("first"))
    return again.select("id", "h", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """``(texts, spans)``: ``texts`` has ``doc_id, _id, _h, _text``, ``spans`` ``id, h, start, end``.

    Spans are in UTF-8 bytes and may touch or overlap. Rows equal in id and text count as one
    document; texts that share an id are ordered by hash; a null id comes before all others; a null
    or empty text, or one shorter than ``length``, has no spans. An empty table gives no rows.
    """
    if not 8 <= gram <= length:
        raise ValueError("gram must be 8 to length")
    # texts are told apart by id alone, unless some id comes more than once
    once = docs.groupBy(F.col(id_col).cast("long")).count().where("count > 1").isEmpty()
    mark = F.lit(0).cast("long") if once else F.xxhash64(F.coalesce(text_col, F.lit("")))
    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        mark.alias("_h"), F.coalesce(text_col, F.lit("")).alias("_text"),
    )
    asked = _resolved(_met(texts, length, gram), length, gram)
    wanted = asked.where("kind = 0")
    met = (F.col("_id") == F.col("id")) & (F.col("_h") == F.col("h"))
    cut = F.substring(F.col("_text").cast("binary"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    # read by both paths; the texts move for it once
    segs = saved(texts.join(wanted, met).select("name", "id", "h", "start", cut.alias("bytes"), "hot"), "segments")
    spans = asked.where("kind = 1").select("id", "h", "start", "end")
    spans = spans.unionByName(_compared(segs.where("hot = 0").drop("hot"), length))
    if not segs.where("hot = 1").isEmpty():
        spans = spans.unionByName(_hot_windows(segs.where("hot = 1").drop("hot", "name"), length))
    return texts, spans


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, spans, kept``.

    ``spans`` are the maximal removed runs (start, end), ``kept`` the remaining bytes in their order; a
    cut may fall inside a character. Options and edge cases are those of ``repeated_spans``.
    """
    texts, spans = repeated_spans(docs, **options)
    per = spans.groupBy("id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = texts.join(per, (F.col("_id") == F.col("id")) & (F.col("_h") == F.col("h")), "left")
    rows = joined.select("doc_id", F.col("_text").cast("binary").alias("text"), F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_, starts, ends = batch.columns[1:]
            size, removed, runs, cut, kept = [], [], [], [], []
            for k in range(batch.num_rows):
                text = texts_[k].as_py()
                a, b = starts[k], ends[k]
                if a.is_valid:
                    zero = np.zeros(len(a), dtype=np.int64)
                    _, _, start, end = _merged(zero, zero, a.values.to_numpy(), b.values.to_numpy())
                    start, end = start.tolist(), end.tolist()
                else:
                    start, end = [], []
                size.append(len(text))
                removed.append(sum(end) - sum(start))
                runs.append(len(start))
                cut.append([{"start": x, "end": y} for x, y in zip(start, end, strict=True)])
                kept.append(b"".join(text[x:y] for x, y in zip([0, *end], [*start, len(text)], strict=True)))
            counts = [pa.array(x, pa.int64()) for x in (size, removed, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *counts, pa.array(cut, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    return rows.mapInArrow(run, schema)
