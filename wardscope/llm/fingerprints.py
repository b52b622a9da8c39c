"""Rabin-Karp fingerprints of byte spans, and packed rows that are dealt out by bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow

LONG_SPAN = 512
HASHES = 4


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Polynomial:
    """Polynomial modulo 2^64 over random values of the bytes. Fingerprints of spans come from sums over prefixes."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.seed = seed
        self.values = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(draw.integers(1 << 60, 1 << 62)) * 8 + 5
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(self.base, -1, 1 << 64)
            for name, base in (("up", self.base), ("down", inverse)):
                steps = np.full(n, base % (1 << 64), dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=sums[1:])
        return sums

    def spans(self, data: np.ndarray, prefixes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Fingerprints of ``data[start:stop]``. Long spans, where such polynomials can be fooled, are hashed one by one."""
        found = mixed((prefixes[stops] - prefixes[starts]) * self.down[starts])
        for i in np.flatnonzero(stops - starts >= LONG_SPAN).tolist():
            found[i] = xxhash.xxh3_64_intdigest(data[starts[i]:stops[i]].tobytes(), self.seed)
        return found


    def chunked(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int = 1 << 14) -> np.ndarray:
        """The same for spans in ascending order, some at a time, so that few prefixes are held."""
        found = np.zeros(len(starts), dtype=np.uint64)
        for at in range(0, len(starts), size):
            a, b = starts[at:at + size], stops[at:at + size]
            part = data[a[0]:b[-1]]
            found[at:at + size] = self.spans(part, self.prefixes(part), a - a[0], b - a[0])
        return found


def codes(fingerprints: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper half) and 32 bits (lower half) of fingerprints; with buckets that grow with the data few codes coincide."""
    high = (fingerprints >> np.uint64(32)) % np.uint64(buckets)
    return (high << np.uint64(32)) | (fingerprints & np.uint64(0xFFFFFFFF))


def bucket_runs(code: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted codes and where their codes lie."""
    bucket = (code >> np.uint64(32)).astype(np.int64)
    edges = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(code)])) if len(code) else np.zeros(1, dtype=np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[a]), slice(a, b)


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.Table]]:
    """Key and rows of every run of equal values of the first column in sorted batches; only the current run is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys, at = batch.column(0), 0
        if held and batch.num_rows and keys[0] != held[0].column(0)[0]:
            yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
            held = []
        values = keys.to_pylist()
        for i in range(1, len(values)):
            if values[i] != values[i - 1]:
                yield values[i - 1], pa.Table.from_batches([*held, batch.slice(at, i - at)])
                held, at = [], i
        if batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def gathered(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Numbers of all binary values of a column, one after another."""
    parts = [np.frombuffer(v.as_buffer(), dtype=kind) for v in column if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def packed_ascending(values: np.ndarray) -> bytes:
    """32-bit numbers in ascending order, as compressed differences, byte by byte."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked_ascending(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def packed_columns(columns: list[np.ndarray]) -> bytes:
    """Arrays of one length, byte by byte and compressed."""
    planes = [np.array([len(columns[0])], dtype="<i8").tobytes()]
    planes += [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked_columns(blob: bytes, kinds: list[type]) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, found = int(raw[:8].view("<i8")[0]), 8, []
    for kind in map(np.dtype, kinds):
        found.append(np.ascontiguousarray(raw[at:at + n * kind.itemsize].reshape(kind.itemsize, n).T).view(kind).reshape(n))
        at += n * kind.itemsize
    return found


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column]


def bit_places(code: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 that give the bits of a code in a Bloom filter."""
    return mixed(code) >> np.uint64(1)


class Bloom:
    """Bloom filter of codes. It may hold more than it was given, never less."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, dtype=np.uint8)

    def __call__(self, code: np.ndarray) -> np.ndarray:
        place = bit_places(code)
        mask, step = np.uint64(8 * len(self.bits) - 1), (place >> np.uint64(32)) | np.uint64(1)
        passes, at = np.ones(len(place), dtype=bool), place & mask
        for _ in range(HASHES):
            passes &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            at = (at + step) & mask
        return passes


def bloom_bits(places: DataFrame, most_bits: int) -> bytes:
    """Bits of a filter of the numbers in the column ``place``: 16 to 32 bits for each, ``most_bits`` in all at most."""
    bits = min(max(1 << (16 * max(places.count(), 1) - 1).bit_length(), 1 << 15), most_bits)
    mask, step = F.lit(bits - 1), F.shiftrightunsigned("place", 32).bitwiseOR(F.lit(1))
    bit = F.col("place").bitwiseAND(mask) + F.col("hash") * step
    bit = bit.bitwiseAND(mask) + 1
    hashes = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HASHES - 1).cast("long"))).alias("hash")
    pieces = places.select("place", hashes).groupBy(F.bitmap_bucket_number(bit).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    whole = bytearray(bits // 8)
    for piece, found in pieces.collect():  # bits / 8 bytes together
        whole[(piece - 1) * 4096:piece * 4096] = found
    return bytes(whole)


def squeezed(df: DataFrame, text: str) -> Column:
    """A text column compressed value by value, for texts that go through an exchange; null as empty."""
    def squeeze(texts: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor(level=3)
        return pa.array([pack.compress(t) for t in texts_of(texts)], pa.binary())

    return apply_arrow(df, squeeze, "binary", text)


def unsqueezed(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of compressed texts."""
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(v) for v in texts_of(column)]
