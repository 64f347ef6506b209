"""Documents packed into token sequences of fixed capacity by sums of squares.

Documents end with an end id; only those longer than a sequence are cut, into full sequences and a
rest. What is left to place are pieces of a known length. A piece goes to the open sequence for which
the sum, over all residual gaps, of the squared number of open sequences with that gap becomes least:
gaps that many sequences share are used up, and none piles up that nothing fits. Pieces come longest
first, and a new sequence is opened only where no open one has room.

Pieces are dealt into blocks of ``BLOCK`` on average, which are packed side by side. Sequences that a
block leaves emptier than ``SLACK`` are opened again and their pieces packed once more, blocks of many
blocks' leftovers at a time, as long as that needs fewer blocks than before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.token_files import encoder_of
from quayside.session import saved

CAPACITY = 2048
# Pieces that are packed together, on average.
BLOCK = 1 << 16
# A sequence of a block is packed again if more than this part of it is empty.
SLACK = 1 / 32
# Sequence numbers: 6 bits of level, 32 of block, 24 of the sequence in its block.
LEVEL_BITS, BLOCK_BITS = 56, 24

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, *, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", ids: bool = False
) -> DataFrame:
    """``PIECES`` of every document, and with ``ids`` their ids (little-endian unsigned 32 bits).

    A document is its text's ids and the end id; a null or empty text is the end id alone. Documents
    of up to ``capacity`` ids are one piece, longer ones are cut every ``capacity`` ids. Repeated rows
    are documents each, a null id stays null; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    schema = PIECES + ", ids binary" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = encoder_of(tokenizer, end_id)
            owner, piece, length, crc, parts = [], [], [], [], []
            for k, packed in enumerate(encoder.encode_all(batch.column(1))):
                data = memoryview(np.frombuffer(packed, dtype=f"<u{encoder.width}").astype("<u4").tobytes())
                for at in range(0, len(data), 4 * capacity):
                    part = data[at : at + 4 * capacity]
                    owner.append(k)
                    piece.append(at // (4 * capacity))
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if ids:
                        parts.append(bytes(part))
            place = pa.array(piece, pa.int32())
            start = pa.array(np.array(piece, dtype=np.int64) * capacity)
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), place, start, pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(parts, pa.binary())] * ids
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])
            encoder.rest()

    return rows.mapInArrow(run, schema)


def placed(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sequence, offset`` of each piece, and how much of each sequence is filled.

    With ``n[g]`` open sequences of gap ``g``, a piece of length ``s`` that goes to one of gap ``g``
    changes the sum of squares by ``2 * (n[g - s] - n[g] + 1)``, or by ``1 - 2 * n[g]`` if it fills
    it. Of equal changes the smallest gap counts.
    """
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    n = np.zeros(capacity, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity)]
    filled: list[int] = []
    none = np.iinfo(np.int64).max
    order = np.argsort(-lengths, kind="stable")
    for i, s in zip(order.tolist(), lengths[order].tolist(), strict=True):
        gap = capacity
        if s < capacity:
            here = n[s:]
            change = np.where(here > 0, 2 * (n[: capacity - s] - here + 1), none)
            if here[0]:
                change[0] = 1 - 2 * here[0]
            least = int(change.argmin())
            if change[least] != none:
                gap = s + least
        if gap == capacity:
            k = len(filled)
            filled.append(0)
        else:
            k = open_[gap].pop()
            n[gap] -= 1
        sequence[i], offset[i] = k, filled[k]
        filled[k] += s
        if gap > s:
            open_[gap - s].append(k)
            n[gap - s] += 1
    return sequence, offset, np.array(filled, dtype=np.int64)


def _block(level: int, last: bool, capacity: int):
    def block(t: pa.Table) -> pa.Table:
        lengths = t.column("length").to_numpy()
        sequence, offset, filled = placed(lengths, capacity)
        again = np.zeros(len(lengths), dtype=bool) if last else (capacity - filled > SLACK * capacity)[sequence]
        base = (level << LEVEL_BITS) + (t.column("_block")[0].as_py() << BLOCK_BITS)
        t = t.drop_columns(["_block"])
        for name, column in (("sequence_id", base + sequence), ("offset", offset), ("_again", again)):
            t = t.append_column(name, pa.array(column))
        return t

    return block


def packed(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; column ``length`` (1 to ``capacity``) says how long each is.

    Offsets of a sequence have no gaps from 0 on. Other columns are carried along and should be
    narrow. No sequence is shared by two blocks; an empty table stays empty.
    """
    rows = saved(pieces, "pieces")
    kinds = [f"`{name}` {kind}" for name, kind in rows.dtypes if name not in ("sequence_id", "offset")]
    rows = rows.drop("sequence_id", "offset")
    blocks, level, done = max(1, -(-rows.count() // BLOCK)), 0, []
    while True:
        # by row, not by content: however often a row repeats, it is spread over all blocks
        dealt = rows.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
        schema = ", ".join([*kinds, "sequence_id long", "offset long", "_again boolean"])
        out = saved(dealt.groupBy("_block").applyInArrow(_block(level, blocks == 1, capacity), schema), "packed")
        left = -(-out.where("_again").count() // BLOCK)
        if not left or left >= blocks:
            done.append(out.drop("_again"))
            break
        done.append(out.where("not _again").drop("_again"))
        rows, blocks, level = out.where("_again").drop("sequence_id", "offset", "_again"), left, level + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def packed_sequences(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, **options) -> DataFrame:
    """The sequences themselves: ``sequence_id, length, ids, doc_ids, starts``.

    ``ids`` are all ids of a sequence (little-endian unsigned 32 bits), ``starts`` the offsets at
    which its pieces begin and ``doc_ids`` whose they are, so attention can be kept within them.
    """
    pieces = saved(token_pieces(docs, tokenizer, capacity=capacity, ids=True, **options).withColumn("row", F.monotonically_increasing_id()), "piece-ids")
    plan = packed(pieces.select("row", "doc_id", "length"), capacity=capacity)
    rows = plan.join(pieces.select(F.col("row").alias("_row"), "ids"), F.col("row") == F.col("_row"))
    members = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))  # no more than capacity of them
    each = rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), members.alias("m"))
    ids = F.aggregate("m", F.lit(b"").cast("binary"), lambda data, x: F.concat(data, x["ids"]))
    return each.select("sequence_id", "length", ids.alias("ids"), F.col("m.doc_id").alias("doc_ids"), F.col("m.offset").alias("starts"))
