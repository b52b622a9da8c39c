"""One document of each group of near copies: SimHash fingerprints, then MinHash bands, propose pairs; exact Jaccard similarity of word shingles decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm import simhash
from wardscope.llm.common import apply_arrow, components, free_name, map_arrow, materialise, with_row

#: Documents are near copies when their similarity is LEAST[0] / LEAST[1] or more.
LEAST = (4, 5)
_DRAW = np.random.default_rng(42)
_FACTORS, _SHIFTS = (_DRAW.integers(1 << 63, size=1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def shingles(text: str | None, width: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``width`` words, words as in ``simhash``; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone are lower-cased, ASCII white space alone divides
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    stops = ends[min(width, len(words)) - 1:]
    starts = np.concatenate(([0], ends[:len(stops) - 1] + 1))
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())], dtype=np.uint64))


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band: a hash of ``rows`` minima of the hashes under random functions."""
    if not len(hashes):
        return hashes
    n = bands * rows
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), 1 << 12):  # a very long text is taken in pieces
        part = hashes[k:k + (1 << 12), None]
        least = np.minimum(least, ((part ^ (part >> np.uint64(29)) ^ _SHIFTS[None, :n]) * _FACTORS[None, :n]).min(axis=0))
    return (least.reshape(bands, rows) * _FACTORS[None, :rows] ^ _SHIFTS[None, :rows]).sum(axis=1, dtype=np.uint64) * _FACTORS[rows]


def similar_links(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect what is similar: a set is compared only with those not reached yet, so there are fewer links than sets."""
    sizes = np.array([len(s) for s in sets])
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(codes.max() + 1, dtype=np.int32)
    left, links = np.arange(1, len(sets)), []
    front = [0]
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        at = front.pop()
        own = codes[offsets[at]:offsets[at] + sizes[at]]
        mark[own] = 1
        common = np.add.reduceat(mark[codes], offsets)[left]
        mark[own] = 0
        near = sum(LEAST) * common >= LEAST[0] * (sizes[left] + sizes[at])
        front += left[near].tolist()
        links += [(nodes[k], nodes[at]) for k in left[near].tolist()]
        left = left[~near]
    return links


def links_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every run of equal ``band, key, low, high`` in sorted batches; only the current run is held."""
    key, nodes, sets = None, [], []

    def flush() -> pa.RecordBatch:
        found = similar_links(nodes, sets) if len(nodes) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("band", "key", "low", "high")))
        for here, node, hashes in zip(keys, batch.column("node").to_pylist(), batch.column("hashes")):
            if here != key:
                yield flush()
                key, nodes, sets = here, [], []
            nodes.append(node)
            sets.append(hashes.values.to_numpy())
    yield flush()


def close_prints(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Pairs ``u, v`` of nodes that connect what has equal fingerprints (column ``print``) or such within ``max_bits`` bits."""
    firsts = distinct.groupBy("print").agg(F.min("node").alias("first"))
    equal = distinct.select("node", "print").join(firsts, "print").where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    tied = simhash.links(firsts.select("print"), max_bits, 6, 4096)
    ends = tied.join(firsts.select(F.col("print").alias("u"), F.col("first").alias("a")), "u").join(
        firsts.select(F.col("print").alias("v"), F.col("first").alias("b")), "v")
    return equal.unionByName(ends.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))


def mixed_links(met: DataFrame, roots: DataFrame, sets: DataFrame, tile: int) -> DataFrame:
    """Links inside the bands' groups that hold documents of several roots; groups of the same documents count once.

    A group of over ``tile`` documents is divided into tiles, and each pair of its tiles is a group of its own.
    """
    names = ["band", "key", "low", "high"]
    seen = met.where("n > 2").join(roots.withColumnRenamed("node", "rooted"), F.col("node") == F.col("rooted"), "left").withColumn(
        "root", F.coalesce("root", "node"))
    mixed = seen.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("members"), F.min("root").alias("a"),
                                            F.max("root").alias("b")).where("a <> b")
    mixed = mixed.groupBy("members", "size").agg(F.min(F.struct("band", "key")).alias("g")).select(
        "g.*", F.ceil(F.col("size") / F.lit(tile)).cast("long").alias("tiles"))
    rows = met.select("band", "key", "node").join(mixed, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("tiles") - 2, F.lit(0)))).alias("other")
    rows = rows.select("band", "key", "node", "own", "tiles", other).withColumn(
        "other", F.when(F.col("tiles") == 1, 0).otherwise(F.col("other") + (F.col("other") >= F.col("own")).cast("long")))
    rows = rows.select("band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node").join(sets, "node")
    return map_arrow(rows.repartition(*names).sortWithinPartitions(*names), links_in_groups, "u long, v long")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, bands: int = 30, rows: int = 5, tile: int = 1024,
             max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each group of near copies: that with the smallest id, and its first copy if rows repeat.

    Documents are linked when the sets of their shingles of ``width`` words (lower-cased in A-Z, cut at ASCII white space)
    have a Jaccard similarity of ``LEAST`` or more, counted exactly; a group is what links connect. Texts without words are
    alike. Documents without an id are kept only if no document of their group has one, and then one of them. The columns
    stay as they are.

    SimHash fingerprints of the sets propose what is connected within ``max_bits`` bits. Pairs of a similarity of 0.8
    are mostly further apart, so MinHash adds those with all ``rows`` minima of one of the ``bands`` equal: of these such a
    pair is missed with a probability of (1 - 0.8^5)^30, some 7 in a million, a closer one less often. Equal sets are one
    document from the start. Each group of a band is first compared with its smallest member; only groups of three or
    more that are not one connected group after that and the fingerprints are compared in full.
    """
    docs, row = with_row(docs, doc_id)
    texts = docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))

    def signed(values: np.ndarray) -> list[int]:
        return values.view(np.int64).tolist()

    def signatures(found: pa.Array) -> pa.Array:
        sets = [shingles(t.as_py(), width) for t in found]
        nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64)
        prints = np.array([simhash.majority(s) for s in sets], dtype=np.uint64)
        return pa.StructArray.from_arrays([pa.array(nodes.view(np.int64)), pa.array(prints.view(np.int64)),
                                           pa.array([signed(band_keys(s, bands, rows)) for s in sets], pa.list_(pa.int64()))], ["node", "print", "keys"])

    def sets_of(found: pa.Array) -> pa.Array:
        return pa.array([signed(shingles(t.as_py(), width)) for t in found], pa.list_(pa.int64()))

    made = texts.select("row", "id", apply_arrow(docs, signatures, "node long, print long, keys array<long>", "text").alias("s"))
    best = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    distinct = made.select("row", "id", "s.*").groupBy("node").agg(best.alias("best"), F.first("print").alias("print"), F.first("keys").alias("keys"))
    distinct = materialise(distinct, "distinct-sets")
    banded = distinct.select("node", F.posexplode("keys").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).where("n > 1")
    met = materialise(banded.join(shared, ["band", "key"]), "met")
    close = materialise(close_prints(distinct, max_bits), "close-prints")
    named = met.select("node").unionByName(close.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    wanted = distinct.join(named, "node").select("node", F.col("best.row").alias("row"))
    sets = materialise(texts.join(wanted, "row").select("node", apply_arrow(docs, sets_of, "array<long>", "text").alias("hashes")), "sets")
    pairs = met.where("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v")).unionByName(close).distinct()
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    near = materialise(both.where(sum(LEAST) * F.size(F.array_intersect("a", "b")) >= LEAST[0] * (F.size("a") + F.size("b"))).select("u", "v"), "near")
    more = materialise(mixed_links(met, components(near), sets, tile), "near")
    roots = components(near.unionByName(more))
    member = distinct.join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").withColumn(
        "root", F.coalesce("root", "node"))
    key = free_name(docs, "kept_row")
    kept = member.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(key))
    left = docs.join(kept, F.col(f"`{row}`").cast("long") == F.col(key), "left_semi")
    return left if row == doc_id else left.drop(row)
