"""Web archives in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardscope.llm.common import frames_by_bytes, map_arrow
from wardscope.llm.seekable import SeekableReader, SeekableWriter

INDEX = "page_id long, record_id string, file string, frame long, offset long, length long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Base32 SHA-1, as in ``WARC-Payload-Digest``."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, payload_digest: str, original: int | None, date: str) -> tuple[str, bytes]:
    """Id and bytes of a WARC record: a response, or without payload a revisit of the page ``original``."""
    name = uuid.uuid4().urn
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if original is not None else http + payload
    fields = [("WARC-Type", "response" if original is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if original is not None:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(original))]
    fields += [("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("X-Payload-Length", str(len(payload))),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return name, head.encode() + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> Iterator[tuple[dict[str, str], bytes | None, int]]:
    """Header fields, payload (None of a revisit) and end of each record from ``start`` on."""
    while start < len(data):
        stop = data.index(b"\r\n\r\n", start)
        version, *lines = data[start:stop].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("no WARC record here")
        fields = dict(line.split(": ", 1) for line in lines)
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        payload = None if fields["WARC-Type"] == "revisit" else data[data.index(b"\r\n\r\n", begin) + 4:end]
        start = end + 4
        yield fields, payload, start


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
                   frame_bytes: int = 1 << 20, bundle_bytes: int = 1 << 28, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes one record per page below ``folder``: bundles ``warc/*.warc.zst`` and the Parquet table ``index``.

    The payload is the html in UTF-8 (null: empty). Of pages with equal payloads of at least ``min_bytes`` bytes that with
    the largest id is a response and the others are revisits of it; rows that share this largest id, and rows of groups
    without any id, are all responses. A bundle is a row of independent Zstandard frames of whole records (about
    ``frame_bytes``; a longer record has its own) up to about ``bundle_bytes``, with a seek table at the end; ``index`` has
    the frame of each record and its offset in it. Repeated rows are written as often as they occur.

    Digests are grouped inside the tasks first; the pages then meet only the digests found twice or more, in a join whose
    uneven keys can be split. Every attempt of a task writes files of new names, and the index names those that count.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")))).withColumn("size", F.coalesce(F.octet_length("html"), F.lit(0)))
    groups = rows.where(F.col("size") >= min_bytes).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("original")).where("n > 1")
    rows = rows.join(groups.select("sha", "original"), "sha", "left").withColumn(
        "original", F.when((F.col("size") >= min_bytes) & ~F.col("original").eqNullSafe(F.col("page_id")), F.col("original")))
    target = f"{folder}/warc"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, held, index, size, total = None, [], [], 0, 0

        def listed() -> pa.RecordBatch:
            columns = list(zip(*index)) or [()] * 5
            pages_of, names, frames, offsets, lengths = columns
            made = [pa.array(pages_of, pa.int64()), pa.array(names, pa.string()), pa.array([writer.name] * len(names), pa.string()),
                    *(pa.array(c, pa.int64()) for c in (frames, offsets, lengths))]
            return pa.RecordBatch.from_arrays(made, names=[f.split()[0] for f in INDEX.split(", ")])

        for batch in batches:
            for page, url, html, sha, original in zip(*(batch.column(c) for c in ("page_id", "url", "html", "sha", "original"))):
                payload = (html.as_py() or "").encode()
                own = base64.b32encode(bytes.fromhex(sha.as_py())).decode()
                name, data = record(page.as_py(), url.as_py(), payload, own, original.as_py(), date)
                writer = writer or SeekableWriter(target, ".warc.zst")
                if size and size + len(data) > frame_bytes:
                    writer.frame(b"".join(held))
                    held, size = [], 0
                    if total > bundle_bytes:
                        writer.close()
                        yield listed()
                        writer, index, total = SeekableWriter(target, ".warc.zst"), [], 0
                index.append((page.as_py(), name, len(writer.entries), size, len(data)))
                held.append(data)
                size, total = size + len(data), total + len(data)
        if writer:
            writer.frame(b"".join(held))
            writer.close()
            yield listed()

    map_arrow(rows.select("page_id", "url", "html", "sha", "original"), write, INDEX).write.parquet(f"{folder}/index")


def read_archives(spark: SparkSession, folder: str, wanted: DataFrame | None = None, with_payload: bool = False) -> DataFrame:
    """Records from the bundles: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest``.

    Sizes and digests of responses are those of the payload read; revisits have those of their header. With ``wanted``
    (column ``page_id``) only the frames with those pages are read, and only their records are parsed. ``with_payload``
    adds the payload (binary, null of revisits).
    """
    index = spark.read.parquet(f"{folder}/index")
    if wanted is not None:
        index = index.join(wanted.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id", "left_semi")
    frames = index.groupBy("file", "frame").agg(F.collect_list("offset").alias("offsets"))
    target = f"{folder}/warc"
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *(["payload"] if with_payload else [])]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_payload else [])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if reader:
                        reader.close()
                    name, reader = row["file"], SeekableReader(target, row["file"])
                data, out = reader.frame(row["frame"]), []
                for offset in row["offsets"]:
                    fields, payload, _ = next(parse(data, offset))
                    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page-ID", "X-Payload-Length")}
                    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if payload is not None and digest(payload) != sha:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                    out.append((number["X-Page-ID"], fields.get("WARC-Target-URI"), fields["WARC-Type"], number["X-Refers-To-Page-ID"],
                                number["X-Payload-Length"] if payload is None else len(payload), sha, *([payload] if with_payload else [])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if reader:
            reader.close()

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string" + (", payload binary" if with_payload else "")
    return map_arrow(frames_by_bytes(index, frames, F.col("length")), read, schema)
