"""Removal of passages that repeat, by content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, free_name, map_arrow, materialise, with_row, with_struct

GEAR = np.random.Generator(np.random.PCG64(2024)).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def gear_hash(data: np.ndarray, span: int = 16) -> np.ndarray:
    """Rolling gear hash (``h = 2 h + gear[byte]``) over the last ``span`` bytes at every byte; ``span`` is a power of two."""
    value, width = GEAR[data], 1
    while width < span:
        moved = np.zeros_like(value)
        moved[width:] = value[:-width] << np.uint32(width)
        value, width = value + moved, 2 * width
    return value & np.uint32((1 << span) - 1)


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space."""
    blank = np.concatenate(([True], _BLANK[np.frombuffer(raw, dtype=np.uint8)], [True]))
    return np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])


def chunk_cuts(hashes: np.ndarray, radius: int = 2, longest: int = 16) -> np.ndarray:
    """Numbers of the words before which chunks begin, with 0 and the number of words.

    A chunk ends after a word whose gear hash is below those of the ``radius`` words before and not above those of the
    ``radius`` words after, so that cuts depend on nearby text alone and an insertion moves none beyond it. What stays
    longer than ``longest`` words (one word over and over) is cut at that length from its start.
    """
    n = len(hashes)
    least = np.ones(n, dtype=bool)
    for d in range(1, radius + 1):
        least[d:] &= hashes[d:] < hashes[:-d]
        least[:-d] &= hashes[:-d] <= hashes[d:]
    cuts = np.unique(np.concatenate(([0], np.flatnonzero(least) + 1, [n])))
    gaps = np.diff(cuts)
    if len(gaps) and gaps.max() > longest:
        cuts = np.concatenate([np.arange(a, a + g, longest) for a, g in zip(cuts[:-1], gaps)] + [[n]])
    return cuts


def windows(text: str | None, min_words: int = 20, radius: int = 2) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Digests and byte spans of the shortest sequences of whole chunks with ``min_words`` words, one from every cut.

    Digests are taken of the words joined by single spaces, so that line breaks make no difference.
    """
    raw = (text or "").encode()
    starts, ends = word_bounds(raw)
    if len(starts) < min_words:
        return [], starts[:0], starts[:0]
    joined = b" ".join(raw.split())
    after = np.cumsum(ends - starts + 1)
    cuts = chunk_cuts(gear_hash(np.frombuffer(joined, dtype=np.uint8))[after - 2], radius)
    last = np.searchsorted(cuts, cuts[:-1] + min_words)
    whole = last < len(cuts)
    a, b = cuts[:-1][whole], cuts[last[whole]]
    begin = np.concatenate(([0], after))
    digests = [xxhash.xxh3_64_intdigest(joined[i:j]) for i, j in zip(begin[a].tolist(), (begin[b] - 1).tolist())]
    return digests, starts[a], np.append(starts, len(raw))[b]


def cut_out(text: str | None, spans: list[dict] | None) -> tuple[str | None, int, bool]:
    """Text without its repeated windows, removed characters, and whether it shares a window.

    A span is removed unless it is the first of its digest in the document that holds the first one of all.
    """
    if text is None or not spans:
        return text, 0, False
    raw = text.encode()
    gone, seen = np.zeros(len(raw) + 1, dtype=np.int32), set()
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["first"] and s["digest"] not in seen:
            seen.add(s["digest"])
        else:
            gone[s["start"]] += 1
            gone[s["stop"]] -= 1
    rest = np.frombuffer(raw, dtype=np.uint8)[np.cumsum(gone[:-1]) == 0].tobytes().decode()
    return rest, len(text) - len(rest), True


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 20, radius: int = 2) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and the columns ``removed_chars`` and ``repeated`` (replaced if there).

    Words are gathered into chunks cut by a gear rolling hash (about five words each); every sequence of whole chunks of
    ``min_words`` words or a little more is a window. Of equal windows (by a 64-bit digest) one stays: the first one in
    the document with the smallest id, or in table order where ids repeat, are null or are no integers. The others are
    cut out, whether in other documents or in the same. ``repeated`` tells that a document holds such a window, the one
    that stays included. A passage loses the words before its first cut and after its last one; from about 40 words on it
    nearly always holds a window. A null text stays null, a text under ``min_words`` words stays as it is, repeated rows
    leave one whole, an empty table gives none.

    Windows are counted per digest inside the tasks before they are exchanged, and only digests found twice meet their
    windows again, in a join whose uneven keys can be split. What is gathered per row is bounded by its own text.
    """
    docs, row = with_row(docs, doc_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [windows(t.as_py(), min_words, radius) for t in part.column(1)]
                sizes = [len(d) for d, _, _ in found]
                rows = np.repeat(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                digests = np.array([x for d, _, _ in found for x in d], dtype=np.uint64).view(np.int64)
                start, stop = (np.concatenate([f[k] for f in found]).astype(np.int32) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array(rows), pa.array(start), pa.array(stop)],
                                                 ["digest", "row", "start", "stop"])

    spans = map_arrow(docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(f"`{text}`").alias("text")), cut,
                      "digest long, row long, start int, stop int")
    twice = spans.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row")).where("n > 1").drop("n")
    twice = materialise(twice, "repeated-windows")
    marked = spans.join(twice, "digest").select("row", F.struct("digest", "start", "stop", (F.col("row") == F.col("first_row")).alias("first")).alias("span"))
    per_row = marked.groupBy("row").agg(F.collect_list("span").alias("spans"))
    key, listed = free_name(docs, "span_row"), free_name(docs, "spans")
    joined = docs.join(per_row.select(F.col("row").alias(key), F.col("spans").alias(listed)), F.col(f"`{row}`").cast("long") == F.col(key), "left")

    def rewrite(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = [cut_out(t.as_py(), s.as_py()) for t, s in zip(texts, spans)]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.StructArray.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_())],
                                          [text, "removed_chars", "repeated"])

    made = apply_arrow(docs, rewrite, f"`{text}` string, removed_chars long, repeated boolean", text, listed)
    out = with_struct(joined, made, [text, "removed_chars", "repeated"])
    order = [c for c in docs.columns if c.lower() not in ("removed_chars", "repeated") and (c != row or row == doc_id)]
    return out.select(*(F.col(f"`{c}`") for c in order), "removed_chars", "repeated")
