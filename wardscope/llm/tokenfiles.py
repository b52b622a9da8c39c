"""Token ids in files of checked frames, and back."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardscope.llm.common import frames_by_bytes, map_arrow
from wardscope.llm.encoding import IDS, encoder
from wardscope.llm.seekable import SeekableReader, SeekableWriter

INDEX = "file string, frame long, doc_id long, position long, first long, n_tokens long"


def write_ids(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1,
              frame_ids: int = 1 << 18, partitions: int | None = None) -> None:
    """Encodes documents and writes their ids below ``folder``: ``ids/*.zst`` and the Parquet table ``index``.

    Documents are ordered by ``doc_id`` (nulls first; copies of one id by the hash of their text) over the files and within
    them. A document is its ids as little-endian unsigned 32-bit integers and ``end_id``; a null or empty text is the end id
    alone. A file holds independent Zstandard frames of whole documents, about ``frame_ids`` ids each (a longer document
    has a frame of its own), each with its checksum, then a seek table. ``index`` has for each document its file, frame,
    place in the frame, first id within the file and number of ids. Copies are written as often as they occur.

    Files come from a sort by ranges, so that only the numbers of ids per file need to be added up. Each attempt of a task
    writes files of new names, and the index names those of the attempts that counted.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions, "doc_id", "tie") if partitions else rows.repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    target = f"{folder}/ids"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, first = encoder(tokenizer).encode, None, 0
        held: list[bytes] = []
        index: list[tuple] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for key, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    writer = writer or SeekableWriter(target, ".ids.zst")
                    if size and size + len(ids) + 1 > frame_ids:
                        writer.frame(b"".join(held))
                        held, size = [], 0
                    held.append(ids.tobytes() + IDS.type(end_id).tobytes())
                    index.append((len(writer.entries), key, size, first, len(ids) + 1))
                    size, first = size + len(ids) + 1, first + len(ids) + 1
                if len(index) >= 20_000:
                    yield listed(writer.name, index)
                    index = []
        if writer:
            writer.frame(b"".join(held))
            writer.close()
            yield listed(writer.name, index)

    map_arrow(rows, write, INDEX).write.parquet(f"{folder}/index")


def listed(name: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                                      names=[f.split()[0] for f in INDEX.split(", ")])


def read_ids(spark: SparkSession, folder: str, wanted: DataFrame | None = None, with_ids: bool = False) -> DataFrame:
    """Documents from the files: ``doc_id, start, n_tokens, ids_crc32`` and with ``with_ids`` the ids (array of long).

    ``start`` counts the ids of all documents before this one. With ``wanted`` (column ``doc_id``) only those documents'
    frames are opened. Frames are the units of work; their checksums are verified, and damage raises an error.
    """
    index = spark.read.parquet(f"{folder}/index")
    files = index.groupBy("file").agg(F.min(F.struct("doc_id", "first")).alias("low"), F.max(F.struct("doc_id", "first")).alias("high"), F.sum("n_tokens").alias("n"))
    # One row per file, as many as the sort had ranges; a range of one id spread over files goes by its end.
    before = Window.orderBy("low.doc_id", "high.doc_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if wanted is not None:
        index = index.join(wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    frames = index.groupBy("file", "frame").agg(F.collect_list(F.struct("doc_id", "position", "first", "n_tokens")).alias("docs"))
    target = f"{folder}/ids"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    if reader:
                        reader.close()
                    name, reader = row["file"], SeekableReader(target, row["file"])
                ids = np.frombuffer(reader.frame(row["frame"]), dtype=IDS)
                own = [ids[d["position"]:d["position"] + d["n_tokens"]] for d in row["docs"]]
                columns = [pa.array([name] * len(own)), *(pa.array([d[c] for d in row["docs"]], pa.int64()) for c in ("doc_id", "first", "n_tokens")),
                           pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                names = ["file", "doc_id", "first", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if reader:
            reader.close()

    schema = "file string, doc_id long, first long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    found = map_arrow(frames_by_bytes(index, frames, IDS.itemsize * F.col("n_tokens")), read, schema)
    shown = ["doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return found.join(base, "file").select(*shown)
