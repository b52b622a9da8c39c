"""Near-duplicate groups by SimHash fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, components, free_name, map_arrow, materialise, with_row

BITS = 64


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned fingerprint of the shingles of ``width`` words, repeats included; zero for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone are lower-cased, ASCII white space alone divides
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = min(width, len(words)) - 1
    stops = ends[last:]
    starts = np.concatenate(([0], ends[:len(stops) - 1] + 1))
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(stops), 1 << 16):  # a very long text is summed in pieces
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in
                           zip(starts[k:k + (1 << 16)].tolist(), stops[k:k + (1 << 16)].tolist())], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """Unsigned fingerprint of given hashes; zero for none."""
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, column: str, width: int = 4) -> DataFrame:
    """Adds the fingerprint as a (signed) long."""
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), width) for t in texts], dtype=np.uint64).view(np.int64), pa.int64())

    return docs.withColumn(column, apply_arrow(docs, prints, "long", text))


def masks(max_bits: int, blocks: int) -> list[int]:
    """Masks (signed) of every choice of blocks that stay equal when ``max_bits`` others differ in one block each."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    chosen = (sum(c) for c in combinations(parts, blocks - max_bits))
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in chosen]


def spanning_links(prints: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, int]]:
    """Links that connect what lies within ``max_bits`` of each other: (members found, the print they are tied to).

    A print is compared only with those not reached yet, so that there are fewer links than prints.
    """
    left, links = prints, []
    while len(left) > 1:
        start, left = left[0], left[1:]
        front = np.array([start], dtype=np.uint64)
        while len(front) and len(left):
            near = (np.bitwise_count(front[:32, None] ^ left[None, :]) <= max_bits).any(axis=0)
            found, left, front = left[near], left[~near], front[32:]
            if len(found):
                links.append((found, start))
                front = np.concatenate((front, found))
    return links


def links_in_groups(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of every run of equal ``band, key, low, high`` in sorted batches; only the current run is held."""
    held = None
    def flush(bounds: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        size = np.diff(bounds)
        two = bounds[:-1][size == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        us, vs = [a[near]], [b[near]]
        for s, e in zip(bounds[:-1][size > 2].tolist(), bounds[1:][size > 2].tolist()):
            for found, start in spanning_links(prints[s:e], max_bits):
                us.append(found)
                vs.append(np.full(len(found), start, dtype=np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (us, vs)], ["u", "v"])

    for batch in batches:
        table = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "key", "low", "high", "print")])
        table = table if held is None else np.concatenate((held, table), axis=1)
        change = np.flatnonzero((table[:4, 1:] != table[:4, :-1]).any(axis=0)) + 1
        done = change[-1] if len(change) else 0
        if done:
            yield flush(np.concatenate(([0], change)), table[4, :done].view(np.uint64))
        held = table[:, done:]
    if held is not None and held.shape[1]:
        yield flush(np.array([0, held.shape[1]]), np.ascontiguousarray(held[4]).view(np.uint64))


def links(prints: DataFrame, max_bits: int, blocks: int, tile: int) -> DataFrame:
    """Links ``u, v`` that connect all of the distinct fingerprints (column ``print``) within ``max_bits`` bits.

    Two prints that differ in at most ``max_bits`` bits are equal in some ``blocks - max_bits`` of the blocks, so they
    meet under the value of those. Prints alone under a value leave after an aggregation. A value with over ``tile``
    prints is divided into tiles, and each pair of its tiles is a group of its own: no group has over twice that many,
    and every two prints of the value meet somewhere. From each group come links that connect, fewer than its prints.
    """
    bands = prints.select("print", F.posexplode(F.array(*(F.col("print").bitwiseAND(F.lit(m)) for m in masks(max_bits, blocks)))).alias(
        "band", "key")).select("print", F.col("band").cast("long").alias("band"), "key")
    shared = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("long")
    met = bands.join(shared, ["band", "key"]).withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("print"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("tiles") - 2, F.lit(0)))).alias("other")
    one = met.where("tiles = 1").select("band", "key", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"), "print")
    many = met.where("tiles > 1").select("band", "key", "own", other, "print").withColumn(
        "other", F.col("other") + (F.col("other") >= F.col("own")).cast("long"))
    grouped = one.unionByName(many.select("band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print"))
    names = ["band", "key", "low", "high"]
    return map_arrow(grouped.repartition(*names).sortWithinPartitions(*names),
                     lambda batches: links_in_groups(batches, max_bits), "u long, v long").distinct()


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4, blocks: int = 6,
                tile: int = 4096) -> DataFrame:
    """One row per document: ``doc_id, print`` (signed long), ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts are lower-cased in A-Z, cut into words at ASCII white space and hashed as shingles of ``width`` words (a
    shorter text as one shingle; a null or empty text has fingerprint zero and is linked like any other). Documents
    whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the smallest id reachable,
    null only if no document there has an id. Repeated rows return as often as they occur, an empty table gives none.

    Equal fingerprints are one before any comparison, however many documents share them. ``blocks`` only sets the cost
    (6 choose 4 keys of about 21 bits by default; 7 makes 35 keys of 27 bits for billions of documents), as ``tile`` does.
    """
    rows = materialise(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "print", width)
                       .select("doc_id", "print"), "prints")
    distinct = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = components(links(distinct.select("print"), max_bits, blocks, tile))
    member = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    member = materialise(member, "members")
    named = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = member.join(named, "root").select("print", "component_id")
    return rows.join(found, "print").select("doc_id", "print", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the smallest id, and its first copy if rows repeat.

    Documents without an id are kept only if no document of their group has one, and then one of them. The columns stay
    as they are.
    """
    docs, row = with_row(docs, doc_id)
    rows = with_fingerprint(docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text")), "text", "print",
                            options.get("width", 4)).select("row", "id", "print")
    rows = materialise(rows, "prints")
    best = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    distinct = materialise(rows.groupBy("print").agg(best.alias("best")), "distinct-prints")
    roots = components(links(distinct.select("print"), options.get("max_bits", 4), options.get("blocks", 6), options.get("tile", 4096)))
    member = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    key = free_name(docs, "kept_row")
    kept = member.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias(key))
    left = docs.join(kept, F.col(f"`{row}`").cast("long") == F.col(key), "left_semi")
    return left if row == doc_id else left.drop(row)
