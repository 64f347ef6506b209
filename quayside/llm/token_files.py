"""Token ids of documents in files of independent zstandard frames with a trailing seek table.

Layout of a file (the public seekable zstandard format, so any zstandard reader can unpack it):

* data frames: the ids of some whole documents, little-endian unsigned, 2 or 4 bytes each; a frame
  takes documents until it has ``FRAME_IDS`` ids, so a longer document has a frame of its own;
* one directory frame: ``DIRECTORY`` records, one per document, after a header of two bytes (the
  version, the bytes per id);
* a skippable frame with the seek table: per frame its compressed size, its size and a checksum (the
  low 32 bits of XXH64), then the footer: number of frames, flags, magic number.

A reader seeks to the footer, takes the directory, and unpacks only frames that hold documents it
was asked for. Every frame carries zstandard's own checksum as well; both are verified.
"""

from __future__ import annotations

import itertools
import posixpath
import string
import struct
import sys
import types
import unicodedata
import uuid
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

FRAME_IDS = 1 << 16
VERSION = 1
LEVEL = 3
# Distinct text pieces whose ids a worker remembers: the last so many, and those it used before them.
KNOWN_PIECES = 200_000
# Fixed values of the seekable zstandard format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = "<III", "<IBI"
DIRECTORY = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("start", "<u8"), ("n", "<u8"), ("frame", "<u4"), ("at", "<u4")])
# Bytes of text whose words are encoded together.
BATCH_BYTES = 1 << 24


# Fixed values of byte-level tokenizers: bytes that stand for themselves as characters. The others
# take the characters from 256 on, in order.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}


class _Known(dict):
    """Ids by piece. What is missing is made, and what was not used for long is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) > KNOWN_PIECES:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece)
        if ids is None:
            ids = self.make(piece)
        self[piece] = ids
        return ids


def _tails(words: pa.Array, heads: np.ndarray) -> pa.Array:
    """What is left of each word behind its first ``heads`` bytes."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32, count=words.offset + len(words) + 1)[words.offset :].astype(np.int64)
    starts, sizes = ends[:-1] + heads, ends[1:] - ends[:-1] - heads
    upto = np.r_[0, np.cumsum(sizes)]
    places = np.repeat(starts - upto[:-1], sizes) + np.arange(upto[-1])
    tails = np.frombuffer(data, dtype=np.uint8)[places] if upto[-1] else np.zeros(0, dtype=np.uint8)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(tails.tobytes()))


class Encoder:
    """Ids of texts as bytes, little-endian, ``width`` bytes each, the end id behind every text.

    A tokenizer that drops white space and never joins over it (``piecewise``) gives a text the ids
    of its pieces between ASCII blanks in a row, and each distinct piece of a batch is encoded once.
    Marks behind a letter or digit are pieces of their own. Plain Latin words take a shorter way through
    the tokenizer (``direct``): normalizing and cutting would not change them but for lower case, so
    they go to its model at once. Any other tokenizer encodes texts whole.
    """

    def __init__(self, path: str, end_id: int):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.end = self._packed([end_id])
        spec = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        split = steps[0] if steps and steps[0]["type"] == "Split" else {}
        self.piecewise = (
            split.get("behavior") == "Removed" and split["invert"] and r"[^\s\p{L}\p{N}]+" in str(split["pattern"].get("Regex")) and spec["post_processor"] is None
        )
        level = steps[1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        self.direct = self.piecewise and level and normal == ["NFC", "Replace", "Lowercase"] and r"[\p{L}]+" in split["pattern"]["Regex"]
        rest = itertools.count(256)
        self.shown = [chr(b) if b in PRINTABLE else chr(next(rest)) for b in range(256)]
        self.known = _Known(self._piece)

    def _packed(self, ids: Iterable[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.direct and "<|" not in piece and piece.isalpha():
            lower = piece.lower()
            if piece.isascii():
                return self._packed([t.id for t in self.model.tokenize(lower)])
            # up to here letters have one lower-case letter each, but for this one
            if max(piece) < "\u0250" and "\u0130" not in piece and unicodedata.is_normalized("NFC", piece):
                shown = "".join(map(self.shown.__getitem__, lower.encode()))
                return self._packed([t.id for t in self.model.tokenize(shown)])
        return self._packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _ids_of(self, distinct: pa.Array) -> pa.Array:
        """Ids of distinct words as bytes. Marks behind a letter or digit are cut off and put back as ids."""
        stems = pc.utf8_rtrim(distinct, characters=string.punctuation)
        ends_well = pc.utf8_is_alnum(pc.utf8_slice_codeunits(stems, -1))
        plain = pc.and_(ends_well, pc.invert(pc.match_substring(distinct, "<|")))
        stems = pc.if_else(plain, stems, distinct)
        if self.direct:
            stems = pc.if_else(pc.ascii_is_alpha(stems), pc.ascii_lower(stems), stems)
        ids = []
        for part in (stems, _tails(distinct, np.asarray(pc.binary_length(stems)))):
            coded, known = part.dictionary_encode(), self.known
            own = pa.array([known[x] if x else b"" for x in coded.dictionary.to_numpy(zero_copy_only=False).tolist()], pa.large_binary())
            ids.append(own.take(coded.indices))
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def rest(self) -> None:
        """Between tasks: keep the words known last, give back the rest."""
        self.known.before = {}
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a batch: its distinct words are encoded once and their ids taken by number."""
        if not self.piecewise:
            return [self._packed(self.tokenizer.encode(t, add_special_tokens=False).ids) + self.end for t in texts.to_pylist()]
        out: list[bytes] = []
        sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_BYTES, side="right")))
            words = pc.ascii_split_whitespace(texts.slice(at, stop - at))
            bounds = words.offsets.to_numpy()
            distinct = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
            ids = self._ids_of(distinct.dictionary).take(distinct.indices)
            # the ids of all words of the batch, one behind the other
            _, offsets, data = ids.buffers()
            places = np.frombuffer(offsets, dtype=np.int64, count=len(ids) + 1)[bounds - bounds[0]].tolist()
            joined = data.to_pybytes() if data is not None else b""
            out += [joined[a:b] + self.end for a, b in zip(places, places[1:], strict=False)]
            at = stop
        return out


def encoder_of(path: str, end_id: int) -> Encoder:
    """An encoder that a Python worker keeps from one task to the next, with the words it knows.

    It is kept by a module of the worker, not by this one, whose code comes anew with every task.
    """
    kept = sys.modules.setdefault("_quayside_encoders", types.ModuleType("_quayside_encoders")).__dict__
    if (path, end_id) not in kept:
        kept.clear()
        kept[path, end_id] = Encoder(path, end_id)
    return kept[path, end_id]


class FileWriter:
    """One file: ids of documents in the order in which they come."""

    def __init__(self, sink, width: int):
        import zstandard

        self.sink, self.width = sink, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True).compress
        self.table: list[bytes] = []
        self.docs: list[tuple] = []
        self.waiting: list[bytes] = []
        self.held, self.total = 0, 0

    def _frame(self, data: bytes) -> None:
        import xxhash

        packed = self.pack(data)
        self.sink.write(packed)
        self.table.append(struct.pack(ENTRY, len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.waiting))
            self.waiting, self.held = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.width
        if self.held and self.held + n > FRAME_IDS:
            self._flush()
        self.docs.append((doc_id is not None, doc_id or 0, self.total, n, len(self.table), self.held))
        self.waiting.append(ids)
        self.held += n
        self.total += n

    def close(self) -> None:
        self._flush()
        self._frame(bytes([VERSION, self.width]) + np.array(self.docs, dtype=DIRECTORY).tobytes())
        table = b"".join(self.table) + struct.pack(FOOTER, len(self.table), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.sink.close()


class FileReader:
    """Reads the directory of a file, and of its frames those that are asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack(FOOTER, self._at(size - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        raw = self._at(size - struct.calcsize(FOOTER) - frames * struct.calcsize(ENTRY), frames * struct.calcsize(ENTRY))
        self.entries = list(struct.iter_unpack(ENTRY, raw))
        self.offsets = [0, *itertools.accumulate(e[0] for e in self.entries)]
        head = self.frame(frames - 1)
        if head[0] != VERSION:
            raise ValueError(f"unknown version {head[0]}")
        self.width = head[1]
        self.docs = np.frombuffer(head, dtype=DIRECTORY, offset=2)

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard

        packed, size, checksum = self.entries[k]
        data = zstandard.ZstdDecompressor().decompress(self._at(self.offsets[k], packed), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return data

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(records, ids)`` by frame, of the wanted documents' frames alone."""
        docs = self.docs
        if wanted is not None:
            docs = docs[np.isin(docs["doc_id"], list(wanted)) & (docs["has_id"] == 1)]
        for k in np.unique(docs["frame"]).tolist():
            yield docs[docs["frame"] == k], np.frombuffer(self.frame(k), dtype=f"<u{self.width}")


def _opened(uri: str):
    from pyarrow import fs

    if uri.startswith("/"):
        uri = f"file://{uri}"
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    return fs.FileSystem.from_uri(uri)


MANIFEST = "part int, file string, docs long, ids long, first_id long, last_id long"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    *,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Encodes all texts and writes them in ascending id order; the manifest, one row per file.

    Documents are range-partitioned by id, null first and ties by text, and every partition is one
    file, written as a stream. A file's name holds the attempt that wrote it and only the manifest
    says which files count, so retried and speculative tasks do no harm. The manifest
    (``part, file, docs, ids, first_id, last_id, base``) is kept in ``folder`` too; ``base`` is the
    number of ids in all files before. A null or empty text is the end id alone; repeated rows are
    written each; an empty table has an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_id").asc_nulls_first(), F.col("_mark")]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = rows.withColumn("_mark", F.xxhash64("_text")).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_mark")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.qtok"
        encoder = encoder_of(tokenizer, end_id)
        filesystem, root = _opened(folder)
        filesystem.create_dir(root, recursive=True)
        writer = FileWriter(filesystem.open_output_stream(posixpath.join(root, name)), encoder.width)
        low = high = None
        for batch in itertools.chain([first], batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                writer.add(doc_id, ids)
                if doc_id is not None:
                    low, high = doc_id if low is None else low, doc_id
        writer.close()
        encoder.rest()
        out = [task.partitionId()], [name], [len(writer.docs)], [writer.total], [low], [high]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=names)

    written = posixpath.join(folder, f"_manifest-{uuid.uuid4().hex[:8]}")
    rows.mapInArrow(write, MANIFEST).write.parquet(written)
    told = sorted(spark.read.schema(MANIFEST).parquet(written).collect())  # bound: one row per file
    bases = [0, *itertools.accumulate(r["ids"] for r in told)]
    return spark.createDataFrame([(*r, b) for r, b in zip(told, bases, strict=False)], f"{MANIFEST}, base long")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files; ``ids`` as little-endian unsigned 32 bits.

    ``start`` is the number of ids of all documents before. With ``doc_ids`` only files and frames
    that hold one of them are read.
    """
    wanted = None if doc_ids is None else set(doc_ids)
    files = manifest.select("file", "base", "part")
    if wanted is not None:
        low, high = (min(wanted), max(wanted)) if wanted else (0, -1)
        files = manifest.where((F.col("first_id") <= high) & (F.col("last_id") >= low)).select("file", "base", "part")
    n = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _opened(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with filesystem.open_input_file(posixpath.join(root, name)) as source:
                    for docs, ids in FileReader(source).documents(wanted):
                        wide = ids.astype("<u4")
                        at, size = docs["at"].tolist(), docs["n"].tolist()
                        arrays = [
                            pa.array(docs["doc_id"], pa.int64(), mask=docs["has_id"] == 0),
                            pa.array(docs["start"].astype(np.int64) + base),
                            pa.array(docs["n"].astype(np.int64)),
                            pa.array([wide[a : a + s].tobytes() for a, s in zip(at, size, strict=True)], pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids"])

    return files.repartitionByRange(min(n, 100_000), "part").mapInArrow(read, DOCUMENTS)


def encoded(docs: DataFrame, tokenizer: str, *, end_id: int, folder: str | None = None, **options) -> DataFrame:
    """Writes token files below ``folder`` (a fresh shared one if not named) and reads them back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer, end_id=end_id, **options))
