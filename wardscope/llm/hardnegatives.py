"""Hard negatives of embeddings by a secondary sort of pair scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wardscope.llm.common import map_arrow, materialise

PACKED = "size int, dim int, ids binary, labels binary, vectors binary"
PAIRS = "anchor_id long, score long, other_id long"


@dataclass
class Block:
    """Rows in ascending order of their ids, with whole components as doubles."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        vectors = np.frombuffer(row["vectors"], dtype=np.float64 if len(row["vectors"]) == 8 * row["size"] * row["dim"] else np.int16)
        return cls(np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["labels"], dtype=np.int64),
                   vectors.reshape(row["size"], row["dim"]).astype(np.float64))

    def packed(self) -> pa.RecordBatch:
        vectors = self.vectors.astype(np.int16) if np.abs(self.vectors).max(initial=0) < 32768 else self.vectors
        values = [[len(self.ids)], [self.vectors.shape[1]], [self.ids.tobytes()], [self.labels.tobytes()], [vectors.tobytes()]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["size", "dim", "ids", "labels", "vectors"])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``; a shorter vector counts as filled up with zeros."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    bound = dim * largest[0] * largest[1]
    if bound < 2.0 ** 53:  # every partial sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    if bound >= 2.0 ** 63 or max(largest) >= 2.0 ** 63:
        raise OverflowError("inner products pass 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def pack(batches: Iterator[pa.RecordBatch], size: int, scale: float) -> Iterator[pa.RecordBatch]:
    """Blocks of up to ``size`` rows of ``id, label, vector``."""
    held: list[pa.RecordBatch] = []

    def blocks(flush: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        whole = table.num_rows if flush else table.num_rows - table.num_rows % size
        for at in range(0, whole, size):
            part = table.slice(at, min(size, whole - at)).combine_chunks()
            order = np.argsort(part.column(0).to_numpy(), kind="stable")
            lists = part.column(2).combine_chunks()
            lengths = np.diff(lists.offsets.to_numpy())
            filled = np.zeros((len(order), int(lengths.max(initial=0))))
            filled[np.arange(filled.shape[1]) < lengths[:, None]] = np.floor(scale * lists.flatten().to_numpy().astype(np.float64))
            yield Block(part.column(0).to_numpy()[order], part.column(1).to_numpy()[order], filled[order]).packed()
        if whole < table.num_rows:
            held.extend(table.slice(whole).to_batches())

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) >= size:
                yield from blocks(False)
    if held:
        yield from blocks(True)


def first_in_rows(values: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` largest allowed values of each row, the leftmost of equal ones first."""
    low = np.iinfo(np.int64).min
    left = np.where(allowed, values, low)
    rows, columns, every = [], [], np.arange(len(values))
    for _ in range(min(n, values.shape[1])):
        best = left.argmax(axis=1)
        found = left[every, best] > low
        rows.append(every[found])
        columns.append(best[found])
        left[every, best] = low
    return np.concatenate(rows or [every[:0]]), np.concatenate(columns or [every[:0]])


def positives_in(anchors: Block, rows: Block, n: int) -> tuple[np.ndarray, ...]:
    """Anchor id, score and id of the first ``n`` rows of the block with the anchor's label."""
    out = []
    for label in np.intersect1d(anchors.labels, rows.labels):
        a, b = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        found = scores(anchors.vectors[a], rows.vectors[b])
        i, j = first_in_rows(found, anchors.ids[a][:, None] != rows.ids[b][None, :], n)
        out.append((anchors.ids[a[i]], found[i, j], rows.ids[b[j]]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (anchors.ids[:0],) * 3


def negatives_in(anchors: Block, rows: Block, bounds: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The same for the first ``n`` rows of another label in each window of scores.

    ``bounds`` has the least and the greatest score of every window of every anchor (anchor, window, 2). Whatever is
    among the first ``n`` of a window over all rows is among the first ``n`` of its block.
    """
    found = scores(anchors.vectors, rows.vectors)
    other = anchors.labels[:, None] != rows.labels[None, :]
    cells = []
    for k in range(bounds.shape[1]):
        inside = other & (found >= bounds[:, k, :1]) & (found <= bounds[:, k, 1:])
        i, j = first_in_rows(found, inside, n)
        cells.append(i * len(rows.ids) + j)
    i, j = np.divmod(np.unique(np.concatenate(cells or [np.zeros(0, dtype=np.int64)])), max(len(rows.ids), 1))
    return anchors.ids[i], found[i, j], rows.ids[j]


def window_bounds(scores_of: list[list[int]], low: int, high: int, windows: int) -> np.ndarray:
    """Least and greatest negative score for each positive score; an empty window where there is no positive."""
    bounds = np.empty((len(scores_of), windows, 2), dtype=np.int64)
    bounds[:, :, 0], bounds[:, :, 1] = 1, 0
    for i, values in enumerate(scores_of):
        for k, p in enumerate(values):
            bounds[i, k] = -(-low * p // 100), high * p // 100
    return bounds


def emit_windows(batches: Iterator[pa.RecordBatch], negatives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Reads pairs ordered by anchor, falling score, positives first, id; gives the negatives of every positive.

    A positive opens a window, a negative goes to each open window whose bounds hold its score, and a window closes
    when it is full or the scores have fallen below it. Only the open windows of the current anchor are held.
    """
    anchor, windows = None, []
    for batch in batches:
        out: list[tuple] = []
        for a, score, other, negative in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "score", "other_id", "negative"))):
            if a != anchor:
                anchor, windows = a, []
            if not negative:
                windows.append([other, score, 0])
                continue
            windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
            for w in windows:
                if 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((a, w[0], w[2], other, w[1], score))
        if out:
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, zip(*out))], names)


def first_positives(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The first ``n`` pairs of every anchor of pairs in that order."""
    anchor, seen = None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        starts = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, dtype=bool)
        place = np.arange(len(ids)) - np.maximum.accumulate(np.where(starts, np.arange(len(ids)), 0))
        if len(ids):
            if ids[0] == anchor:
                first = int(np.argmax(ids != anchor)) if (ids != anchor).any() else len(ids)
                place[:first] += seen
            anchor, seen = int(ids[-1]), int(place[-1]) + 1
        yield batch.filter(pa.array(place < n))


def secondary_sort(pairs: DataFrame, *order: str | Column) -> DataFrame:
    """Pairs dealt out by their anchor and sorted by the whole key inside the partitions (repartitionAndSortWithinPartitions)."""
    return pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), *order)


def hard_negatives(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, block: int = 2048, anchor_block: int = 512) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    The score of two rows is the inner product of their components ``floor(scale * x)``; higher scores come first, ties
    by the smaller id. For each row that meets ``anchor`` its positives are the first rows of its label besides itself,
    and for each positive the first ``negatives`` rows of other labels with ``low`` to ``high`` per cent of its score
    come back, in the order of ``rank``.

    Rows with a null id, label or vector or with a component that is null or not finite take no part. Rows that share an
    id count as one, that with the least label, then the least vector. Vectors of different lengths are compared over
    the shared components. Other columns are not looked at; labels that are no integers are compared by 64-bit hashes. An
    empty table, or one without anchors, gives no rows. Scores that pass 64 bits raise an error.

    Rows are packed into blocks; every block of anchors meets every block of rows, an equi-join on the number of a part
    of the row blocks. A task hands on no more than the first pairs of its block for each anchor and window, which is
    exact, so what is shuffled does not grow with the square of the rows. Those pairs are dealt out by anchor, sorted
    by falling score inside the partitions, and read by an iterator that holds the open windows of one anchor.
    """
    spark = rows.sparkSession
    whole = isinstance(rows.schema[label].dataType, IntegralType)
    values = F.col(f"`{vector}`")
    used = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"),
                       (F.col(f"`{label}`").cast("long") if whole else F.when(F.col(f"`{label}`").isNotNull(), F.xxhash64(F.col(f"`{label}`")))).alias("label"),
                       values.cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    infinite = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    used = used.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~infinite)
    n_rows, n_ids, n_anchors = used.agg(F.count(F.lit(1)), F.countDistinct("id"), F.count_if("anchor")).first()
    if n_ids < n_rows:
        used = used.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row")).select("id", "row.*")
    used = used.select("id", "label", "vector", "anchor")

    tasks = max(spark.sparkContext.defaultParallelism, 1)
    blocks = max(-(-n_rows // block), 1)
    parts = max(min(blocks, 4 * tasks), -(-blocks // 64))  # a part has up to 64 blocks of rows, some 16 MB
    number = F.pmod(F.xxhash64("ids"), F.lit(parts)).alias("part")
    packed_rows = materialise(map_arrow(used.drop("anchor").repartition(parts), lambda b: pack(b, block, scale), PACKED), "vector-blocks").select(
        number, *(F.col(c).alias(f"row_{c}") for c in ("size", "dim", "ids", "labels", "vectors")))
    few = used.where("anchor").drop("anchor").repartition(max(-(-n_anchors // anchor_block), 1))
    packed_anchors = materialise(map_arrow(few, lambda b: pack(b, anchor_block, scale), PACKED).withColumn("block", F.xxhash64("ids")), "anchor-blocks")

    def meet(anchors: DataFrame) -> DataFrame:
        every = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return every.join(packed_rows, "part").drop("part")

    def sides(row: dict) -> tuple[Block, Block]:
        return Block.of(row), Block.of({k.removeprefix("row_"): v for k, v in row.items() if k.startswith("row_")})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = positives_in(*sides(batch.slice(i, 1).to_pylist()[0]), positives)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["anchor_id", "score", "other_id"])

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors, others = sides(row)
                known = {p["anchor_id"]: p["scores"] for p in row["known"] or []}
                bounds = window_bounds([known.get(a, []) for a in anchors.ids.tolist()], low, high, positives)
                found = negatives_in(anchors, others, bounds, negatives)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["anchor_id", "score", "other_id"])

    sorted_near = secondary_sort(map_arrow(meet(packed_anchors), near, PAIRS), "other_id")
    chosen = materialise(map_arrow(sorted_near, lambda b: first_positives(b, positives), PAIRS), "positives")

    def members(ids: bytes) -> list[int]:
        return np.frombuffer(ids, dtype=np.int64).tolist()

    inside = map_arrow(packed_anchors.select("block", "ids"), lambda batches: (
        pa.RecordBatch.from_arrays([pa.array([b] * len(m), pa.int64()), pa.array(m, pa.int64())], ["block", "anchor_id"])
        for batch in batches for b, m in zip(batch.column(0).to_pylist(), map(members, batch.column(1).to_pylist()))), "block long, anchor_id long")
    scored = chosen.groupBy("anchor_id").agg(F.collect_list("score").alias("scores"))
    known = inside.join(scored, "anchor_id").groupBy("block").agg(F.collect_list(F.struct("anchor_id", "scores")).alias("known"))
    pairs = map_arrow(meet(packed_anchors.join(known, "block")), hard, PAIRS)
    keyed = chosen.withColumn("negative", F.lit(False)).unionByName(pairs.withColumn("negative", F.lit(True)))
    return map_arrow(secondary_sort(keyed, "negative", "other_id"), lambda b: emit_windows(b, negatives, low, high),
                     "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
