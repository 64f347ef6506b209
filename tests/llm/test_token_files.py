import glob
import io
import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from quayside.llm import token_files
from quayside.llm.queries import tokenizer_path
from tests.llm.corpus import SCHEMA, documents, frame

ODD = [
    "Don't stop. It's 'quoted'... we'll, they'd! O'Neil's", "a\x1cb \x1d c\x85d\xa0e f　g\x0bh\x0ci", "<|endoftext|> x<|startoftext|>y <|EndOfText|>",
    "İstanbul ΣΑΣ ﬁne é ä ́x", "²³ ½ 12.5, 3.14! x². é. ß: 中文。中文.", "emoji 😀😀 👩‍👩‍👧. zero​width ﻿",
    "UPPER.lower;Mixed:case!? ...,,, a.b.c. -- '' \"\" `", "\t\n\r", "\x00\x01 nul", "word" * 5000,
]


def rows_of():
    return documents() + [(600 + i, t, "en", "s", 1, 0.5, 1, "w") for i, t in enumerate(ODD)]


def whole_ids(texts, path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [[*e.ids, 2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_give_the_ids_of_whole_texts(monkeypatch, name):
    texts = [r[1] or "" for r in rows_of()]
    for known in (300_000, 5):
        monkeypatch.setattr(token_files, "KNOWN_PIECES", known)
        encoder = token_files.Encoder(tokenizer_path(name), 2)
        assert encoder.piecewise == encoder.direct == name.startswith("word")
        for text, want in zip(texts, whole_ids(texts, tokenizer_path(name))):
            assert np.frombuffer(encoder.encode(text), dtype=f"<u{encoder.width}").tolist() == want, text[:50]


def test_round_trip_in_id_order(spark, tmp_path):
    rows = rows_of()
    got = token_files.encoded(frame(spark, rows), tokenizer_path(), end_id=2, folder=str(tmp_path / "t"), files=4).collect()
    got = sorted(got, key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(r[0] for r in rows if r[0] is not None)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    want = sorted((str(r[0]), np.array(x, dtype="<u4").tobytes()) for r, x in zip(rows, whole_ids([r[1] for r in rows], tokenizer_path())))
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got) == want
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in got)


def test_files_are_seekable_zstandard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 300)
    folder = str(tmp_path / "t")
    manifest = token_files.write_token_files(frame(spark, rows_of()), folder, tokenizer_path(), end_id=2, files=2)
    for path in glob.glob(f"{folder}/*.qtok"):
        raw = open(path, "rb").read()
        frames, flags, magic = struct.unpack("<IBI", raw[-9:])
        assert (flags, magic) == (0x80, 0x8F92EAB1) and frames > 3
        skip, size = struct.unpack("<II", raw[-9 - 12 * frames - 8 : -9 - 12 * frames])
        assert (skip, size) == (0x184D2A5E, 12 * frames + 9)
        at = 0
        for packed, plain, check in struct.iter_unpack("<III", raw[-9 - 12 * frames : -9]):
            data = zstandard.ZstdDecompressor().decompress(raw[at : at + packed])
            assert len(data) == plain and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF == check
            assert zstandard.get_frame_parameters(raw[at : at + packed]).has_checksum
            at += packed
    assert sum(r["docs"] for r in manifest.collect()) == len(rows_of())


def test_only_wanted_frames_are_unpacked(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    sink = io.BytesIO()
    sink.close = lambda: None
    writer = token_files.FileWriter(sink, 2)
    for i in range(20):
        writer.add(i, np.arange(i, i + 4, dtype="<u2").tobytes())
    writer.close()
    sink.size = lambda: len(sink.getvalue())
    reader, read = token_files.FileReader(sink), []
    take = reader.frame
    monkeypatch.setattr(reader, "frame", lambda k: read.append(k) or take(k))
    found = [(d["doc_id"].tolist(), ids.tolist()) for d, ids in reader.documents({5})]
    assert found == [([5], [4, 5, 6, 7, 5, 6, 7, 8])] and read == [2]
    broken = bytearray(sink.getvalue())
    broken[len(broken) // 4] ^= 255
    bad = io.BytesIO(bytes(broken))
    bad.size = lambda: len(broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.FileReader(bad).documents())


def test_lookup_and_empty_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    manifest = token_files.write_token_files(frame(spark, rows_of()), folder, tokenizer_path(), end_id=2, files=3)
    got = token_files.read_token_files(spark, folder, manifest, [3, 601, 77777]).collect()
    assert {r["doc_id"] for r in got} == {3, 601}
    every = {(r["doc_id"], r["start"]): r["ids"] for r in token_files.read_token_files(spark, folder, manifest).collect()}
    assert all(every[(r["doc_id"], r["start"])] == r["ids"] for r in got)
    assert token_files.read_token_files(spark, folder, manifest, []).collect() == []
    assert token_files.encoded(spark.createDataFrame([], SCHEMA), tokenizer_path(), end_id=2).collect() == []


def test_checksums_of_the_query(spark):
    from quayside.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want, at = [], 0
    for (doc_id, _), ids in zip(docs, whole_ids([t for _, t in docs], tokenizer_path())):
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op8_token_files"](spark, sf).collect()) == want
