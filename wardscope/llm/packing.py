"""Packing of tokenised documents into sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, map_arrow, materialise
from wardscope.llm.encoding import IDS, encoder


def pieces(docs: DataFrame, tokenizer: str, capacity: int, doc_id: str, text: str, end_id: int, with_ids: bool) -> DataFrame:
    """Documents as ids with an end id, cut into full pieces of ``capacity`` and the rest, one row for each."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[tuple] = []
                for key, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids = np.append(ids, IDS.type(end_id))
                    for start in range(0, len(ids), capacity):
                        own = ids[start:start + capacity]
                        rows.append((key, start, len(own), zlib.crc32(own.tobytes()), len(ids), *([own.astype(np.int32)] if with_ids else [])))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], names=[f.name for f in shape])

    key_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {key_type}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    wanted = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type
    shape = [pa.field("doc_id", to_arrow_type(docs.schema[doc_id].dataType)), *(pa.field(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens")),
             *([pa.field("ids", pa.list_(pa.int32()))] if with_ids else [])]
    return map_arrow(wanted, cut, schema)


def size_class(length: Column, capacity: int, exact: int = 64, step: int = 8) -> Column:
    """Length up to ``exact``, above it the next multiple of ``step``, at most ``capacity``."""
    return F.when(length <= exact, length).otherwise(F.least(F.ceil(length / step) * step, F.lit(capacity))).cast("long")


def best_patterns(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Value of the most valuable multiset of sizes within the capacity, and patterns of above 1 (columns of counts).

    One unbounded knapsack by dynamic programming prices them all: for each size, the best pattern that holds it.
    """
    order = np.flatnonzero(values > 1e-12)[::-1]  # large sizes first among equal gains
    own, worth = sizes[order], values[order]
    reach = len(own) - np.searchsorted(own[::-1], np.arange(capacity + 1), side="right")
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(own.min()) if len(own) else capacity + 1, capacity + 1):
        gain = best[room - own[reach[room]:]] + worth[reach[room]:]
        top = int(gain.argmax())
        best[room] = gain[top]
        choice[room] = top + reach[room]
    found = []
    for k in np.flatnonzero(worth + best[capacity - own] > 1 + 1e-9):
        counts, room = np.zeros(len(sizes)), capacity - int(own[k])
        counts[order[k]] = 1
        while choice[room] >= 0:
            counts[order[choice[room]]] += 1
            room -= int(own[choice[room]])
        found.append(counts)
    return float(best[capacity]), np.unique(np.array(found), axis=0).T if found else np.zeros((len(sizes), 0))


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 3e-3, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used in the linear relaxation of the cutting-stock problem.

    Revised simplex from one pattern per size. Patterns priced above 1 by the knapsack under the duals join the columns,
    until there are none, the dual bound shows that less than ``gap`` is left to gain, or ``rounds`` are over; the
    basis covers the demand at any time, so that ending early costs some padding and nothing else. Demands are shifted by less than a hundredth each, so that no two sizes run out at once and no step stalls.
    """
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    demand = demand + 0.01 * (np.arange(1, n + 1) * 0.6180339887 % 1)
    inverse, use = np.diag(1.0 / np.diag(basis)), demand / np.diag(basis)
    columns = np.zeros((n, 0))
    for _ in range(rounds):
        worth, new = best_patterns(sizes, inverse.sum(axis=0), capacity)
        if not new.shape[1] or 1 - 1 / worth <= gap:
            break
        columns = np.concatenate((columns[:, np.einsum("i,ij->j", inverse.sum(axis=0), columns) > 0.97], new), axis=1)
        for _ in range(4 * n):
            price = np.einsum("i,ij->j", inverse.sum(axis=0), columns)  # no BLAS: its threads would fight with tasks on a busy host
            k = int(price.argmax())
            if price[k] <= 1 + 1e-9:
                break
            move = (inverse * columns[:, k]).sum(axis=1)
            ratio = np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1), np.inf)
            out = int(ratio.argmin())
            basis[:, out] = columns[:, k]
            use = np.maximum(use - ratio[out] * move, 0)
            use[out] = ratio[out]
            row = inverse[out] / move[out]
            inverse -= np.outer(move, row)
            inverse[out] = row
    return np.rint(basis).astype(np.int64), use


def integral(sizes: np.ndarray, demand: np.ndarray, capacity: int, patterns: np.ndarray, use: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole counts: the relaxation rounded down, and what is left by the largest size that fits first."""
    left, made = demand.copy(), []
    for k in np.argsort(-use, kind="stable"):
        column = patterns[:, k]
        times = int(use[k] + 1e-9)
        if column.any():
            times = min(times, int((left[column > 0] // column[column > 0]).min()))
        if times and column.any():
            made.append((column, times))
            left = left - times * column
    while left.any():
        column, room = np.zeros_like(left), capacity
        for i in np.argsort(-sizes, kind="stable"):
            column[i] = min(left[i], room // sizes[i])
            room -= column[i] * sizes[i]
        times = max(1, int((left[column > 0] // column[column > 0]).min()))
        made.append((column, times))
        left = left - times * column
    return made


def plan(histogram: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each size: rising ranks at which a pattern takes over, its items of that size, first sequence and first slot.

    Full sizes get one sequence each; the others follow the column generation over the histogram.
    """
    full = histogram.get(capacity, 0)
    sizes = np.array(sorted(s for s in histogram if s < capacity), dtype=np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    places: dict[int, list[tuple[int, int, int, int]]] = {int(s): [] for s in sizes}
    if full:
        places[capacity] = [(0, 1, 0, 0)]
    sequence, ranks = full, np.zeros(len(sizes), dtype=np.int64)
    for column, times in integral(sizes, demand, capacity, *column_generation(sizes, demand, capacity)) if len(sizes) else []:
        slot = 0
        for i in np.flatnonzero(column)[::-1]:
            places[int(sizes[i])].append((int(ranks[i]), int(column[i]), sequence, slot))
            ranks[i] += times * column[i]
            slot += int(column[i])
        sequence += times
    return {s: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for s, rows in places.items()}


def place(sizes: np.ndarray, ranks: np.ndarray, places: dict[int, tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and slot of each item by its size and its rank among items of that size."""
    sequence, slot = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for s in np.unique(sizes):
        own = sizes == s
        first, count, base, start = places[int(s)]
        k = np.searchsorted(first, ranks[own], side="right") - 1
        copy, item = np.divmod(ranks[own] - first[k], count[k])
        sequence[own], slot[own] = base[k] + copy, start[k] + item
    return sequence, slot


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1,
         buckets: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of documents with their places: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length``.

    Each document is its ids and ``end_id``. Every full ``capacity`` of them is a sequence of its own; the rests, sorted
    into size classes, are packed by the patterns of a cutting-stock linear program over the histogram of classes (at
    most some 310, whatever the number of documents), which is all that reaches the driver. Rounded down patterns and a
    fit of what is left give each rank within a class its sequence and slot; documents take ranks in the order of a hash
    bucket and their id. ``offset`` counts from 0 without gaps. ``padded_length`` is ``capacity``, or what the sequence
    holds where that is a power of two. A null or empty text is the end id alone; repeated rows are packed as often as
    they occur; an empty table gives none. ``with_ids`` adds the piece's ids (``sequences`` joins them).

    No size class is ever ranked in one task: ranks are counted in ``buckets`` of each class, which a table of their sums
    joins. Texts are encoded once, and only the numbers are exchanged (and the ids, where asked for).
    """
    rows = pieces(docs, tokenizer, capacity, doc_id, text, end_id, with_ids)
    rows = rows.withColumn("size", size_class(F.col("length"), capacity)).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    rows = materialise(rows, "pieces")
    counts = materialise(rows.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = dict(counts.groupBy("size").agg(F.sum("n")).collect())
    places = plan(histogram, capacity)
    base = counts.select("size", "bucket", (F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).alias("base"))
    order = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(order)).join(base, ["size", "bucket"])

    def located(sizes: pa.Array, ranks: pa.Array) -> pa.Array:
        sequence, slot = place(sizes.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False), places)
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(slot)], ["sequence_id", "slot"])

    ranked = ranked.withColumn("rank", F.col("base") + F.col("rank") - 1)
    ranked = ranked.withColumn("at", apply_arrow(docs, located, "sequence_id long, slot long", "size", "rank"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*kept, F.col("at.sequence_id").alias("sequence_id"), F.col("at.slot").alias("slot"))
    own = Window.partitionBy("sequence_id")
    total = F.sum("length").over(own)
    return ranked.select(*kept, "sequence_id", (F.sum("length").over(own.orderBy("slot")) - F.col("length")).alias("offset"),
                         F.when(total.bitwiseAND(total - 1) == 0, total).otherwise(F.lit(capacity)).cast("long").alias("padded_length"))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence from pieces with ids: ``sequence_id, ids`` (without padding), bounded by the capacity."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
