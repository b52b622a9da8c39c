"""Tokens of the sections of documents, from one encoding of the whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import map_arrow
from wardscope.llm.encoding import Encoder, encoder

RULES = ("first", "last", "most")


def token_bounds(text: str, ids: np.ndarray, coder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the text where each token begins and ends. Byte-level tokens cover the text one after another."""
    if coder.by_space:
        stops = np.cumsum(coder.sizes[ids])
        return stops - coder.sizes[ids], stops
    place = np.concatenate(([0], np.cumsum([len(c.encode()) for c in text])))
    spans = np.array(coder.tokenizer.encode(text, add_special_tokens=False).offsets, dtype=np.int64).reshape(-1, 2)
    return place[spans[:, 0]], place[spans[:, 1]]


def allocate(begins: np.ndarray, stops: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Section of each token; sections cover the text and begin at ``starts`` (bytes, rising, the first at 0).

    A token that crosses a boundary goes to the section of its first byte, of its last byte, or to that which holds most
    of its bytes (the first of equals).
    """
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.maximum(np.searchsorted(starts, np.maximum(stops - 1, begins), side="right") - 1, first)
    if rule == "first":
        return first
    if rule == "last":
        return last
    chosen = first.copy()
    for t in np.flatnonzero(last > first).tolist():
        edges = np.concatenate(([begins[t]], starts[first[t] + 1:last[t] + 1], [stops[t]]))
        chosen[t] = first[t] + int(np.diff(edges).argmax())
    return chosen


def line_starts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and characters at which the lines of a text begin; a line ends with its line break."""
    sizes = [(len(line.encode()) + 1, len(line) + 1) for line in text.split("\n")]
    bounds = np.concatenate((np.zeros((1, 2), dtype=np.int64), np.cumsum(sizes, axis=0)))
    return bounds[:-1, 0], bounds[:-1, 1]


def section_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", rule: str = "first",
                   sections: str | None = None) -> DataFrame:
    """One row per section of each document: ``doc_id, section, start_char, n_chars, n_tokens, n_crossing``.

    The whole text is encoded once, and each token goes by its span to a section by ``rule`` (``first``, ``last`` or ``most``,
    see ``allocate``), so that the sections' tokens add up to those of the document. ``n_crossing`` counts those of a section's
    tokens that reach into another one. Sections are the lines, each with the line break that ends it, or begin at the
    characters listed in the column ``sections`` (array of integers in any order; those outside the text are ignored, and
    0 is always one). A null or empty text has one empty section. Repeated rows return as often as they occur.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    key_type = docs.schema[doc_id].dataType
    wanted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                         (F.col(f"`{sections}`").cast("array<long>") if sections else F.lit(None).cast("array<long>")).alias("sections"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                made = []
                for text, ids, given in zip(texts, coder.encode(texts), part.column(2).to_pylist() if sections else [None] * len(texts)):
                    if sections:
                        chars = np.array(sorted({0, *(c for c in given or () if c is not None and 0 < c < len(text))}), dtype=np.int64)
                        place = np.concatenate(([0], np.cumsum([len(text[a:b].encode()) for a, b in zip(chars, chars[1:])], dtype=np.int64)))
                        starts = place.astype(np.int64)
                    else:
                        starts, chars = line_starts(text)
                    begins, stops = token_bounds(text, ids, coder)
                    own = allocate(begins, stops, starts, rule)
                    ends = np.append(starts[1:], np.iinfo(np.int64).max)
                    crossing = (begins < starts[own]) | (stops > ends[own])
                    made.append((chars, np.diff(np.append(chars, len(text))), np.bincount(own, minlength=len(starts)),
                                 np.bincount(own[crossing], minlength=len(starts))))
                sizes = np.array([len(m[0]) for m in made])
                columns = [np.concatenate([m[k] for m in made]) for k in range(4)]
                number = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(number), *(pa.array(c.astype(np.int64)) for c in columns)],
                                                 names=["doc_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing"])

    return map_arrow(wanted, count, f"doc_id {key_type.simpleString()}, section long, start_char long, n_chars long, n_tokens long, n_crossing long")
