"""Archives and token files: exact round trips, single frames, damage."""

from __future__ import annotations

import base64
import glob
import hashlib
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from wardscope.llm import catalog
from wardscope.llm.common import shared_folder
from wardscope.llm.seekable import SeekableReader, SeekableWriter
from wardscope.llm.tokenfiles import read_ids, write_ids
from wardscope.llm.warc import parse, read_archives, write_archives


def test_frames_are_read_alone_and_checked(tmp_path):
    writer = SeekableWriter(str(tmp_path), ".zst")
    data = [b"first" * 100, b"", bytes(range(256)) * 50]
    assert [writer.frame(d) for d in data] == [0, 1, 2]
    writer.close()
    reader = SeekableReader(str(tmp_path), writer.name)
    assert [reader.frame(k) for k in (2, 0, 1)] == [data[2], data[0], data[1]]
    raw = bytearray((tmp_path / writer.name).read_bytes())
    assert zstandard.ZstdDecompressor().stream_reader(bytes(raw), read_across_frames=True).read() == b"".join(data)
    raw[14] ^= 1
    (tmp_path / "bad").write_bytes(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        SeekableReader(str(tmp_path), "bad").frame(0)
    (tmp_path / "none").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        SeekableReader(str(tmp_path), "none")


def test_token_files(spark, small):
    docs = sorted(catalog.table(spark, small, "documents").select("doc_id", "text").collect())
    plain = Tokenizer.from_file(catalog.tokenizer(catalog.WORD_BPE))
    start, expected = 0, set()
    for key, text in docs:
        ids = plain.encode(text, add_special_tokens=False).ids + [1]
        expected.add((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = catalog.QUERIES["op4_token_files"](spark, small).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_token_files_by_document(spark):
    frame = spark.createDataFrame([(5, "a b"), (5, "c"), (None, None), (-2, ""), (9, "word " * 500)], "doc_id long, text string")
    path = shared_folder(spark, "test-ids")
    write_ids(frame, path, catalog.tokenizer(catalog.WORD_BPE), frame_ids=3, partitions=3)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.start), r.n_tokens, r.ids) for r in read_ids(spark, path, with_ids=True).collect())
    assert [r[0][2] for r in rows] == np.cumsum([0] + [r[1] for r in rows[:-1]]).tolist()
    assert [r[0][1] for r in rows] == [0, -2, 5, 5, 9] and rows[0][2] == [1] and rows[4][1] == 501
    wanted = spark.createDataFrame([(9,), (77,)], "doc_id long")
    (only,) = read_ids(spark, path, wanted).collect()
    assert only.doc_id == 9 and only.n_tokens == 501 and only.start == sum(r[1] for r in rows[:-1])
    empty = shared_folder(spark, "test-ids")
    write_ids(frame.limit(0), empty, catalog.tokenizer(catalog.WORD_BPE))
    assert read_ids(spark, empty).collect() == []


def plain_records(rows, min_bytes=0):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == raw and p is not None]
        first = max(same) if same and len(raw) >= min_bytes else None
        revisit = first is not None and page != first
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_pages(spark, small):
    rows = [tuple(r) for r in catalog.table(spark, small, "pages").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in catalog.QUERIES["op3_warc_bundles"](spark, small).collect()), key=str) == plain_records(rows)


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_archives(spark, min_bytes):
    rows = [(1, "http://a/ b\r\nX: y", "same é"), (7, None, "same é"), (3, "http://c", "same é"), (4, "u", None), (5, "u", ""), (6, "u", "ab"), (8, "u", "ab"),
            (None, "u", "ab"), (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (10, "u", "x" * 5000)]
    path = shared_folder(spark, "test-warc")
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), path, min_bytes=min_bytes, frame_bytes=600, bundle_bytes=2000)
    got = read_archives(spark, path, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain_records(rows, min_bytes)
    assert all(r.payload.decode() == (dict((p, h) for p, _, h in rows)[r.page_id] or "") for r in got if r.record_type == "response")
    (one,) = read_archives(spark, path, spark.createDataFrame([(10,)], "page_id long")).collect()
    assert one.payload_bytes == 5000
    files = glob.glob(f"{path.removeprefix('file:')}/warc/*.warc.zst")
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True).read() for f in files)
    assert len(list(parse(whole))) == len(rows) and len(files) >= 2


def test_no_pages(spark):
    path = shared_folder(spark, "test-warc")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archives(spark, path).collect() == []
