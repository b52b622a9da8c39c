"""Removal of byte strings that an earlier document has, by suffix order and longest previous factors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, map_arrow, materialise, with_row
from wardscope.llm.fingerprints import Bloom, Polynomial, bit_places, bloom_bits, bucket_runs, codes, gathered, grouped, mixed, squeezed, texts_of, unsqueezed

SEED, FIRST, SECOND = (Polynomial(s) for s in (1201, 1202, 1203))
SEED_BYTES, LONGEST_RUN = 16, 64
SPANS = "row long, start int, stop int"


@dataclass
class Runs:
    """Runs of neighbouring windows with one code, in some texts written one after another.

    A window is every string of ``length`` bytes, its code the least hash of the short strings in it. Equal windows have
    equal codes, so they are in runs of the same code.
    """

    data: np.ndarray
    code: np.ndarray
    first: np.ndarray  # byte of ``data``
    windows: np.ndarray
    row: np.ndarray
    start: np.ndarray  # byte of the text


def seed_hashes(data: np.ndarray, size: int = SEED_BYTES) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from every byte on, by doubling."""
    value, width = SEED.values[data], 1
    while width < size:
        value = value[:-width] * np.uint64(pow(SEED.base, width, 1 << 64)) + value[width:]
        width *= 2
    return mixed(value)


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row."""
    size, n = 1, len(values) - width + 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size:width - size + n])


def runs(parts: list[tuple[int, int, bytes]], buckets: int, length: int) -> Runs:
    """Runs of the windows of parts of texts (row, byte of the text, bytes)."""
    data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
    sizes = np.array([len(p[2]) for p in parts], dtype=np.int64)
    ends = np.cumsum(sizes)
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return Runs(data, none.astype(np.uint64), none, none, none, none)
    size = min(SEED_BYTES, 1 << length.bit_length() - 1)
    code = codes(least_ahead(seed_hashes(data, size), length - size + 1), buckets)
    inside = np.zeros(len(data) + 1, dtype=np.int32)  # windows that start where their text has length bytes left
    long = sizes >= length
    np.add.at(inside, (ends - sizes)[long], 1)
    np.add.at(inside, (ends - length + 1)[long], -1)
    inside = np.cumsum(inside[:len(code)]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (code[1:] != code[:-1])
    first = np.flatnonzero(new)
    stop = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True)) + 1
    if len(first) and (stop - first).max() > LONGEST_RUN:
        pieces = -(-(stop - first) // LONGEST_RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, stop = np.repeat(first, pieces) + nth * LONGEST_RUN, np.repeat(stop, pieces)
        stop = np.minimum(stop, first + LONGEST_RUN)
    part = np.searchsorted(ends, first, side="right")
    rows, bases = (np.array([p[k] for p in parts], dtype=np.int64) for k in (0, 1))
    return Runs(data, code[first], first, stop - first, rows[part], first - (ends - sizes)[part] + bases[part])


def parts_of(rows: list[int], texts: list[bytes], limit: int, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Parts of about ``limit`` bytes together. Parts of a long text overlap, so that each window is in one of them."""
    held, size = [], 0
    for row, text in zip(rows, texts):
        for at in range(0, max(len(text) - length + 1, 1), limit):
            held.append((row, at, text[at:at + limit + length - 1]))
            size += len(held[-1][2])
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def one_each(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ordered by code and row."""
    order = np.lexsort((row, code))
    row, code = row[order], code[order]
    kept = np.ones(len(code), dtype=bool)
    kept[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    return row[kept], code[kept]


def row_lists(row: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, how often each occurs, and the values in the order of the rows."""
    order = np.argsort(row, kind="stable")
    rows, sizes = np.unique(row, return_counts=True)
    return rows, sizes.astype(np.int32), values[order]


def requests(batches: Iterator[pa.RecordBatch], buckets: int, length: int, limit: int, flush: int) -> Iterator[pa.RecordBatch]:
    """Codes of the texts by bucket, and at once those codes that several texts of a batch have.

    ``shared`` is the number of codes that are known already; one entry of each goes to the bucket, first in order and
    with the number of its rows. Answers known here are rows with ``shared = -1``.
    """
    names = ["bucket", "shared", "rows", "sizes", "codes"]

    def packed(row: np.ndarray, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        row, code = one_each(row, code)
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(first, len(code)))
        shared = np.repeat(times > 1, times)
        rows, sizes, known = row_lists(row[shared], code[shared])
        out = [(0, -1, rows, sizes, known)] if len(rows) else []
        lone, lone_row = code[~shared], row[~shared]
        many, many_times = code[first][times > 1], times[times > 1]
        there = {b: s for b, s in bucket_runs(many)}
        alone = {b: s for b, s in bucket_runs(lone)}
        empty = slice(0, 0)
        for b in sorted({*there, *alone}):
            s, t = there.get(b, empty), alone.get(b, empty)
            rows, sizes, left = row_lists(lone_row[t], lone[t])
            out.append((b, s.stop - s.start, rows, np.concatenate((many_times[s].astype(np.int32), sizes)),
                        np.concatenate((many[s], left)).astype(np.uint32)))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                          *(pa.array([v.tobytes() for v in c], pa.binary()) for c in columns[2:])], names)

    held, size = [], 0
    for batch in batches:
        for parts in parts_of(batch.column(0).to_pylist(), texts_of(batch.column(1)), limit, length):
            found = runs(parts, buckets, length)
            held.append((found.row, found.code))
            size += len(found.data)
            if size >= flush:
                yield from packed(*(np.concatenate(c) for c in zip(*held)))
                held, size = [], 0
    if held:
        yield from packed(*(np.concatenate(c) for c in zip(*held)))


def answers(batches: Iterator[pa.RecordBatch], most: int, pages: int) -> Iterator[pa.RecordBatch]:
    """Codes that other rows have as well, packed by page of rows, and ``place`` of each code of over ``most`` rows."""
    names, kinds = ["page", "rows", "sizes", "codes", "place"], [pa.int32(), *[pa.binary()] * 3, pa.int64()]

    def listed(row: np.ndarray, code: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
        rows, sizes, code = row_lists(row, code)
        page = page_of(rows, pages)
        out = [(None, None, None, None, p) for p in bit_places(hot).astype(np.int64).tolist()]
        of_code = np.repeat(page, sizes)
        for p in np.unique(page).tolist():
            own = page == p
            out.append((p, rows[own].tobytes(), sizes[own].tobytes(), code[of_code == p].tobytes(), None))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], names)

    none = np.zeros(0, dtype=np.uint64)
    for bucket, table in grouped(batches):
        rows, code, weight = [], [], []
        for _, shared, row, sizes, values in zip(*(table.column(c).to_pylist() for c in table.column_names)):
            row, sizes = np.frombuffer(row, dtype=np.int64), np.frombuffer(sizes, dtype=np.int32)
            if shared < 0:
                yield listed(np.repeat(row, sizes), np.frombuffer(values, dtype=np.uint64), none)
                continue
            low = np.frombuffer(values, dtype=np.uint32)
            rows += [np.full(shared, -1, dtype=np.int64), np.repeat(row, sizes[shared:])]
            weight += [sizes[:shared].astype(np.int64), np.ones(len(low) - shared, dtype=np.int64)]
            code.append(low)
        if sum(map(len, code)):
            row, low, n = np.concatenate(rows), np.concatenate(code), np.concatenate(weight)
            order = np.argsort(low, kind="stable")
            row, low, n = row[order], low[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
            total = np.add.reduceat(n, first)
            wanted = np.repeat(total > 1, np.diff(np.append(first, len(low)))) & (row >= 0)
            above = np.uint64(bucket) << np.uint64(32)
            yield listed(row[wanted], above | low[wanted].astype(np.uint64), above | low[first][total > most].astype(np.uint64))


def page_of(row: np.ndarray, pages: int) -> np.ndarray:
    return (mixed(row.view(np.uint64)) % np.uint64(pages)).astype(np.int64)


def codes_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row, codes`` from the pages."""
    for _, table in grouped(batches):
        rows, sizes, code = row_lists(np.repeat(gathered(table.column(1), np.int64), gathered(table.column(2), np.int32)), gathered(table.column(3), np.uint64))
        edges = np.concatenate(([0], np.cumsum(sizes))).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([code[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())], ["row", "codes"])


@dataclass
class Segments:
    """Runs with their bytes, written one after another."""

    code: np.ndarray
    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    data: np.ndarray

    def offsets(self, length: int) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.windows.astype(np.int64) + length - 1)))

    def taken(self, index: np.ndarray, length: int) -> Segments:
        first, sizes = self.offsets(length)[index], self.windows[index].astype(np.int64) + length - 1
        return Segments(self.code[index], self.row[index], self.start[index], self.windows[index], cut_bytes(self.data, first, sizes))

    def packed(self) -> bytes:
        parts = [np.array([len(self.code)], dtype=np.int64), self.code, self.row, self.start.astype(np.int32), self.windows.astype(np.int32), self.data]
        return zstandard.ZstdCompressor(level=3).compress(b"".join(p.tobytes() for p in parts))

    @classmethod
    def unpacked(cls, blob: bytes) -> Segments:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, at, columns = int(np.frombuffer(raw, dtype=np.int64, count=1)[0]), 8, []
        for kind in (np.uint64, np.int64, np.int32, np.int32):
            columns.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
            at += columns[-1].nbytes
        return cls(*columns, np.frombuffer(raw, dtype=np.uint8, offset=at))

    @classmethod
    def joined(cls, parts: list[Segments]) -> Segments:
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("code", "row", "start", "windows", "data")))


def cut_bytes(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes ``data[first:first + size]`` one after another."""
    before = np.cumsum(sizes) - sizes
    return data[np.arange(sizes.sum()) + np.repeat(first - before, sizes)]


def segments(batches: Iterator[pa.RecordBatch], hot: Bloom, buckets: int, length: int, limit: int, flush: int) -> Iterator[pa.RecordBatch]:
    """Runs whose code other rows have, with their bytes, packed by bucket; of equal runs in a batch of texts those in the first row alone.

    The windows of the others are in a smaller row: they go ahead as spans without bytes (``ready``). A run with a hot
    code is dealt out window by window under hashes of whole windows.
    """
    def seen(parts: list[tuple[int, int, bytes]], wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """Code, digests, place in ``parts``, windows, row and place in the text of the runs that are wanted."""
        found = runs(parts, buckets, length)
        kept = np.isin(found.code, wanted)
        code, first, windows, row, start = (c[kept] for c in (found.code, found.first, found.windows, found.row, found.start))
        often = hot(code)
        n = np.where(often, windows, 1)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        code, first, windows, row, start, often = (np.repeat(c, n) for c in (code, first, np.where(often, 1, windows), row, start, often))
        first, start = first + nth, start + nth
        one, two = (p.spans(found.data, p.prefixes(found.data), first, first + windows + length - 1) for p in (FIRST, SECOND))
        return np.where(often, codes(one, buckets), code), one, two, first, windows, row, start

    def packed(held: list[tuple[np.ndarray, ...]], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        code, one, two, first, windows, row, start = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((start, row, two, one))
        one, two, code, first, windows, row, start = (c[order] for c in (one, two, code, first, windows, row, start))
        new = np.ones(len(one), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        later = row > row[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(new) else new
        again = np.flatnonzero(later)
        again = again[np.lexsort((start[again], row[again]))]
        a, b = start[again], start[again] + windows[again]
        fresh = np.ones(len(again), dtype=bool)
        fresh[1:] = (row[again][1:] != row[again][:-1]) | (a[1:] > b[:-1])  # runs beside each other are one span
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:], len(again)) - 1
        blobs = []
        if len(begin):
            ready = Segments(np.zeros(len(begin), dtype=np.uint64), row[again][begin], a[begin], b[last] - a[begin], data[:0])
            blobs.append((int(page_of(ready.row[:1], buckets)[0]), True, ready.packed()))
        kept = np.flatnonzero(~later)
        kept = kept[np.argsort(code[kept], kind="stable")]
        for bucket, s in bucket_runs(code[kept]):
            own = kept[s]
            blobs.append((bucket, False, Segments(code[own], row[own], start[own], windows[own], cut_bytes(data, first[own], windows[own] + length - 1)).packed()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*blobs)) or [()] * 3, [pa.int32(), pa.bool_(), pa.binary()])],
                                         ["bucket", "ready", "blob"])

    held, joined, size = [], [], 0
    for batch in batches:
        wanted = np.unique(gathered(batch.column(2), np.uint64))
        for parts in parts_of(batch.column(0).to_pylist(), unsqueezed(batch.column(1)), limit, length):
            columns = seen(parts, wanted)
            held.append((*columns[:3], columns[3] + size, *columns[4:]))
            joined += [p[2] for p in parts]
            size += sum(len(p[2]) for p in parts)
            if size >= flush:
                yield from packed(held, joined)
                held, joined, size = [], [], 0
    if held:
        yield from packed(held, joined)


def longest_previous(value: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest match of each suffix with one of a smaller value.

    ``value`` and ``lcp`` (with the suffix before) are in suffix order. The best match is the nearest suffix before or
    behind with a smaller value; all suffixes look for theirs at once, each step skipping what the last one reached has
    skipped, and give up when less than ``least`` bytes are shared.
    """
    def nearest(value: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        """Bytes shared with the previous smaller value."""
        to, shared = np.arange(len(value)) - 1, lcp.copy()
        open_ = np.flatnonzero((shared >= least) & (to >= 0))
        while True:
            open_ = open_[value[to[open_]] >= value[open_]]
            if not len(open_):
                break
            via = to[open_]
            shared[open_] = np.minimum(shared[open_], shared[via])
            to[open_] = to[via]
            lost = (shared[open_] < least) | (to[open_] < 0)
            shared[open_[lost]] = 0
            open_ = open_[~lost]
        shared[to < 0] = 0
        return np.where(shared >= least, shared, 0)

    if not len(value):
        return np.zeros(0, dtype=np.int64)
    ahead = np.concatenate(([0], lcp[1:]))
    behind = np.concatenate((lcp[1:], [0]))
    return np.maximum(nearest(value, ahead), nearest(value[::-1], behind[::-1])[::-1])


def suffix_order(data: np.ndarray, starts: np.ndarray, value: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes from ``starts`` by their first ``length`` bytes, then by value, and the bytes shared with the one before."""
    width = -(-length // 8) * 8
    keys = np.zeros((len(starts), width), dtype=np.uint8)
    keys[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[starts]
    columns = keys.view(">u8").astype(np.uint64)
    order = np.lexsort((value, *columns.T[::-1]))
    keys = keys[order]
    lcp = np.zeros(len(starts), dtype=np.int64)
    for at in range(1, len(starts), 1 << 16):
        differ = keys[at:at + (1 << 16), :length] != keys[at - 1:at - 1 + len(keys[at:at + (1 << 16)]), :length]
        lcp[at:at + (1 << 16)] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return order, lcp


def earlier_spans(found: Segments, length: int) -> tuple[np.ndarray, ...]:
    """``row, start, stop`` of the bytes that a smaller row has, for whole groups of segments ordered by code, content and row."""
    code, row, data, offsets = found.code, found.row, found.data, found.offsets(length)
    start, windows = found.start.astype(np.int64), found.windows.astype(np.int64)
    sizes = np.diff(offsets)
    new = np.ones(len(code), dtype=bool)
    maybe = np.flatnonzero((code[1:] == code[:-1]) & (sizes[1:] == sizes[:-1])) + 1
    if len(maybe):
        index = np.minimum(np.arange(sizes.max()), (sizes[maybe] - 1)[:, None])
        new[maybe] = (data[offsets[maybe][:, None] + index] != data[offsets[maybe - 1][:, None] + index]).any(axis=1)
    heads = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    least = row[heads]  # contents are ordered by row
    later = row > least[of]
    spans = [(row[later], start[later], start[later] + windows[later] + length - 1)]

    group = np.cumsum(np.concatenate(([0], code[heads][1:] != code[heads][:-1]))) if len(heads) else heads
    several = heads[np.bincount(group)[group] > 1] if len(heads) else heads  # contents that share their code with others
    if len(several):
        n = windows[several]
        source = np.repeat(several, n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        order, lcp = suffix_order(data, offsets[source] + nth, row[source], length)
        gone = np.zeros(len(source), dtype=bool)
        gone[order] = longest_previous(row[source][order], lcp, length) >= length
        edge = np.concatenate(([True], source[1:] != source[:-1]))
        begin = np.flatnonzero(gone & (edge | ~np.concatenate(([False], gone[:-1]))))
        stop = np.flatnonzero(gone & np.concatenate((edge[1:] | ~gone[1:], [True]))) + 1
        owner, a, b = of[source[begin]], nth[begin], nth[stop - 1] + length
        # every place in the first row that has the content
        firsts = np.flatnonzero(~later)
        low, high = np.searchsorted(of[firsts], owner, side="left"), np.searchsorted(of[firsts], owner, side="right")
        times = high - low
        place = firsts[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
        spans.append((row[place], start[place] + np.repeat(a, times), start[place] + np.repeat(b, times)))
    return tuple(np.concatenate(c) for c in zip(*spans))


def find_earlier(batches: Iterator[pa.RecordBatch], length: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Spans of the segments of each bucket; groups of one code are worked off together, about ``rows`` segments at a time."""
    def made(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(row.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], ["row", "start", "stop"])

    for _, table in grouped(batches):
        parts = []
        for ready, blob in zip(table.column(1).to_pylist(), table.column(2).to_pylist()):
            found = Segments.unpacked(blob)
            if ready:
                yield made(found.row, found.start, found.start + found.windows + length - 1)
            else:
                parts.append(found)
        if not parts:
            continue
        found = Segments.joined(parts)
        offsets = found.offsets(length)
        one, two = (p.chunked(found.data, offsets[:-1], offsets[1:]) for p in (FIRST, SECOND))
        order = np.lexsort((found.row, two, one, found.code))
        code = found.code[order]
        at = 0
        while at < len(code):
            stop = min(at + rows, len(code))
            stop = int(np.searchsorted(code, code[stop - 1], side="right"))
            yield made(*earlier_spans(found.taken(order[at:stop], length), length))
            at = stop


def cut_text(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """Text without the spans, removed bytes and removed runs."""
    if not len(spans):
        return text, 0, 0
    depth = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(depth, spans[:, 0], 1)
    np.add.at(depth, spans[:, 1], -1)
    gone = np.cumsum(depth[:-1]) > 0
    rest = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return rest, len(text) - len(rest), int((gone & ~np.concatenate(([False], gone[:-1]))).sum())


def remove_earlier(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 50, most: int = 10_000,
                   bucket_bytes: int = 1 << 24, limit: int = 1 << 20, flush: int = 1 << 23, rows: int = 1 << 14, most_bits: int = 1 << 29) -> DataFrame:
    """One row per document: ``doc_id, kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts are UTF-8 bytes; every byte covered by a string of ``length`` bytes that also starts in a document with a
    smaller id is removed, so that the first copy stays. Strings are judged on the input and do not cross documents;
    matches inside one document do not count. ``n_spans`` counts the runs removed, ``kept_sha256`` is the lower-case hex
    digest of what is left. A null text counts as empty, a text under ``length`` bytes stays whole, an empty table gives
    no rows, and other columns are not looked at. Where ids repeat, are null or are no integers, the stored order of the
    rows takes the place of the ids: of equal rows the first stays.

    Each window of ``length`` bytes belongs to the least hash of its short strings; neighbours with one hash are a run.
    Hashes are dealt out by bucket, packed, to learn which of them several documents have. Only those runs are sent with
    their bytes, and of equal runs in a batch of texts only the first. Where a hash has different runs, their windows are
    put in suffix order with the bytes shared by neighbours; the previous and next smaller documents in that order give
    the longest previous factor of each, and those of ``length`` bytes are removed. Hashes of over ``most`` documents,
    known to all tasks by a Bloom filter of 64 MB at most, are dealt out by whole windows instead, so that no task gets
    all runs of a frequent string. Memory of a task is bounded by ``flush``, ``rows``, ``most`` and its longest text.
    """
    docs, row = with_row(docs, doc_id)
    used = docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(f"`{text}`").alias("text"))
    size = used.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    asked = map_arrow(used.where(F.octet_length("text") >= length), lambda b: requests(b, buckets, length, limit, flush),
                      "bucket int, shared int, rows binary, sizes binary, codes binary")
    dealt = asked.repartition(buckets, F.when(F.col("shared") < 0, F.xxhash64("rows")).otherwise(F.col("bucket"))).sortWithinPartitions("bucket")
    pages = max(1, -(-size // (4 * bucket_bytes)))
    told = materialise(map_arrow(dealt, lambda b: answers(b, most, pages), "page int, rows binary, sizes binary, codes binary, place long"), "shared-codes")
    paged = told.where("page IS NOT NULL").drop("place").repartition(pages, "page").sortWithinPartitions("page")
    lists = map_arrow(paged, codes_by_row, "row long, codes binary")
    hot = docs.sparkSession.sparkContext.broadcast(bloom_bits(told.where("place IS NOT NULL").select("place"), most_bits))

    small = used.select("row", squeezed(used, "text").alias("text"))
    runs_of = map_arrow(small.join(lists, "row").select("row", "text", "codes"), lambda b: segments(b, Bloom(hot.value), buckets, length, limit, flush),
                        "bucket int, ready boolean, blob binary")
    spans = map_arrow(runs_of.repartition(buckets, "bucket").sortWithinPartitions("bucket"), lambda b: find_earlier(b, length, rows), SPANS)
    gone = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def rewrite(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for raw, found in zip(unsqueezed(texts), spans):
            pairs = np.stack([found.values.field(k).to_numpy() for k in (0, 1)], axis=1) if found.is_valid else np.zeros((0, 2), dtype=np.int32)
            kept, removed, n = cut_text(raw, pairs)
            out.append((kept, len(raw), removed, n, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    both = small.join(gone, "row", "left")
    made = both.select("row", apply_arrow(both, rewrite, "kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string", "text", "spans").alias("made"))
    if row == doc_id:
        return made.select(F.col("row").cast(docs.schema[row].dataType).alias("doc_id"), "made.*")
    ids = docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(f"`{doc_id}`").alias("doc_id"))
    return ids.join(made, "row").select("doc_id", "made.*")
