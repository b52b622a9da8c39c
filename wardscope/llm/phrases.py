"""Phrases whose words stand together more often than their parts, by Rabin-Karp fingerprints of all word sequences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardscope.llm.common import map_arrow, materialise, with_row
from wardscope.llm.fingerprints import Bloom, Polynomial, bit_places, bloom_bits, bucket_runs, codes, gathered, grouped, packed_ascending, packed_columns, squeezed, texts_of, unpacked_ascending, unpacked_columns, unsqueezed

FIRST, SECOND = Polynomial(1301), Polynomial(1302)
LONGEST = 4
SEPARATORS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(SEPARATORS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUT = re.compile(b"[" + re.escape(SEPARATORS) + b"]")
_WORD = rb"[^ \t" + re.escape(SEPARATORS) + rb"]+"
_PHRASES = [re.compile(_WORD + rb"(?:[ \t]+" + _WORD + rb"){%d}" % k) for k in range(LONGEST)]


@dataclass
class Words:
    """Words of some texts, written with one blank between words of a piece."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    linked: np.ndarray  # the next word stands in the same piece
    rows: np.ndarray
    places: np.ndarray  # byte of the text at which the word starts

    def spans(self, n: int) -> np.ndarray:
        """Whether ``n`` words from each one on stand in one piece (as many as there are such sequences at all)."""
        size = max(len(self.starts) - n + 1, 0)
        whole = np.ones(size, dtype=bool)
        for k in range(n - 1):
            whole &= self.linked[k:k + size]
        return whole


def words(parts: list[tuple[int, int, bytes]]) -> Words:
    """Words of parts of texts (row, byte of the text, bytes); parts end where pieces end."""
    raw = np.frombuffer(b"\n".join(p[2] for p in parts) + b"\n", dtype=np.uint8)
    kind = _KIND[raw]
    inside = np.concatenate(([False], kind == 0))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    divided = np.cumsum(kind == 2)
    linked = divided[ends[:-1]] == divided[starts[1:] - 1]
    linked &= kind[ends[:-1]] != 2
    data = _LOWER[raw]
    data[starts[1:] - 1] = 32
    kept = kind == 0
    kept[starts[1:] - 1] = True
    offsets = np.cumsum([0] + [len(p[2]) + 1 for p in parts])
    part = np.searchsorted(offsets, starts, side="right") - 1
    rows, bases = (np.array([p[k] for p in parts], dtype=np.int64) for k in (0, 1))
    sizes = ends - starts
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    return Words(data[kept], begin, begin + sizes, np.append(linked, False)[:len(starts)], rows[part], starts - offsets[part] + bases[part])


def parts_of(rows: list[int], texts: list[bytes], limit: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Parts of about ``limit`` bytes together; a longer text is cut behind separators, so that no piece is divided."""
    held, size = [], 0
    for row, text in zip(rows, texts):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > limit:
                near = max(text.rfind(bytes([c]), at, at + limit) for c in SEPARATORS)
                found = None if near >= at else _CUT.search(text, at + limit)
                stop = near + 1 if near >= at else found.end() if found else stop
            held.append((row, at, text[at:stop]))
            size, at = size + stop - at, stop
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def by_language(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[str, Words]]:
    """Words of the texts of each language in a batch of ``row, lang, text``."""
    for at in range(0, batch.num_rows, 2000):
        some = batch.slice(at, 2000)
        for lang in some.column(1).unique().to_pylist():
            part = some.filter(pc.equal(some.column(1), lang))
            for parts in parts_of(part.column(0).to_pylist(), texts_of(part.column(2)), limit):
                yield lang, words(parts)


def salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def short_counts(batches: Iterator[pa.RecordBatch], buckets: int, least: int, limit: int, flush: int) -> Iterator[pa.RecordBatch]:
    """Counts (``least`` at most) of the fingerprints of one and two words in each bucket, added up over some texts."""
    held, size = [], 0

    def packed() -> Iterator[pa.RecordBatch]:
        code, n = np.unique(np.concatenate(held), return_counts=True)
        n = np.minimum(n, least).astype(np.uint16)
        low = code.astype(np.uint32)
        runs = list(bucket_runs(code))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in runs], pa.int32()), pa.array([packed_ascending(low[s]) for _, s in runs], pa.binary()),
                                          pa.array([n[s].tobytes() for _, s in runs], pa.binary())], ["bucket", "codes", "counts"])

    for batch in batches:
        for lang, found in by_language(batch, limit):
            sums, tint = FIRST.prefixes(found.data), salt(lang)
            for n in (1, 2):
                first = np.flatnonzero(found.spans(n))
                prints = FIRST.spans(found.data, sums, found.starts[first], found.ends[first + n - 1])
                held.append(codes(prints ^ tint, buckets))
                size += len(first)
            if size >= flush:
                yield from packed()
                held, size = [], 0
    if size:
        yield from packed()


def frequent_codes(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Numbers that give the bits of the filter for the codes counted ``least`` times or more over all rows of their bucket."""
    for bucket, table in grouped(batches):
        low, n = np.concatenate([unpacked_ascending(v) for v in table.column(1).to_pylist()]), gathered(table.column(2), np.uint16)
        order = np.argsort(low)
        low, n = low[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1]))) if len(low) else np.zeros(0, dtype=np.int64)
        often = low[first][np.add.reduceat(n, first) >= least] if len(first) else low
        places = bit_places((np.uint64(bucket) << np.uint64(32)) | often.astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64))], ["place"])


#: Fingerprints, words, count, row and place of a sequence.
ENTRY = [np.uint64, np.uint32, np.uint8, np.int64, np.int64, np.int64]


def merged(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """Entries with the counts of equal sequences added up and their first occurrence, in the order of the fingerprints."""
    one, two, n, times, row, place = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((place, row, n, two, one))
    one, two, n, times, row, place = (c[order] for c in (one, two, n, times, row, place))
    first = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (n[1:] != n[:-1]))))
    return [one[first], two[first], n[first], np.add.reduceat(times, first), row[first], place[first]]


def often(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sequences counted ``least`` times or more over all rows of their bucket, and the words of each language."""
    for _, table in grouped(batches):
        parts: dict[str, list] = {}
        for lang, blob in zip(table.column(1).to_pylist(), table.column(2).to_pylist()):
            parts.setdefault(lang, []).append(tuple(unpacked_columns(blob, ENTRY)))
        for lang, columns in parts.items():
            one, two, n, times, row, place = merged(columns)
            kept = np.flatnonzero((times >= least) | (n == 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(kept), pa.string()), pa.array(n[kept].astype(np.int32)), pa.array(one[kept].view(np.int64)), pa.array(two[kept].view(np.int32)),
                 pa.array(times[kept]), pa.array(row[kept]), pa.array(place[kept])], ["lang", "n", "print", "second", "a", "row", "place"])


def counted(batches: Iterator[pa.RecordBatch], known: Bloom, buckets: int, limit: int, flush: int) -> Iterator[pa.RecordBatch]:
    """Sequences whose words and pairs of words pass the filter, packed by language and bucket.

    Each has its fingerprints, the number of its words, its count in some texts together and the first occurrence there; a
    sequence of no words counts all words.
    """
    held: dict[str, list] = {}
    total: dict[str, int] = {}
    size = 0

    def packed() -> Iterator[pa.RecordBatch]:
        rows = []
        for lang, n in total.items():
            held.setdefault(lang, []).append(tuple(np.array([v], dtype=k) for v, k in zip((0, 0, 0, n, 0, 0), ENTRY)))
        for lang, columns in held.items():
            found = merged(columns)
            bucket = ((found[0] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order])) + 1
            rows += [(int(bucket[at[0]]), lang, packed_columns([c[at] for c in found])) for at in np.split(order, edges)]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32(), pa.string(), pa.binary()])], ["bucket", "lang", "blob"])

    for batch in batches:
        for lang, found in by_language(batch, limit):
            total[lang] = total.get(lang, 0) + len(found.starts)
            sums = [p.prefixes(found.data) for p in (FIRST, SECOND)]
            tint, pairs = salt(lang), None
            for n in range(1, LONGEST + 1):
                if n <= 2:
                    first = np.flatnonzero(found.spans(n))
                else:  # all pairs of words inside are known
                    run = pairs[:max(len(pairs) - n + 2, 0)].copy()
                    for k in range(1, n - 1):
                        run &= pairs[k:k + len(run)]
                    first = np.flatnonzero(run)
                a, b = found.starts[first], found.ends[first + n - 1]
                one = FIRST.spans(found.data, sums[0], a, b)
                if n <= 2:
                    passes = known(codes(one ^ tint, buckets))
                    first, a, b, one = first[passes], a[passes], b[passes], one[passes]
                    if n == 2:
                        pairs = np.zeros(max(len(found.starts) - 1, 0), dtype=bool)
                        pairs[first] = True
                if len(first):
                    columns = (one, SECOND.spans(found.data, sums[1], a, b).astype(np.uint32), np.full(len(first), n, dtype=np.uint8),
                               np.ones(len(first), dtype=np.int64), found.rows[first], found.places[first])
                    held.setdefault(lang, []).append(columns)
                    size += len(first)
            if size >= flush:
                yield from packed()
                held, total, size = {}, {}, 0
    if held or total:
        yield from packed()


def phrase_at(text: bytes, place: int, n: int) -> bytes:
    """The ``n`` words of a piece from a byte on, in lower case with single blanks."""
    found = _PHRASES[n - 1].match(text, place).group().lower()
    return b" ".join(w for w in found.replace(b"\t", b" ").split(b" ") if w)


def read_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the sequences that ``found`` points to, each compared with its fingerprints."""
    for batch in batches:
        out: list[tuple] = []
        for text, found in zip(unsqueezed(batch.column(0)), batch.column(1).to_pylist()):
            for f in found:
                phrase = phrase_at(text, f["place"], f["n"])
                data = np.frombuffer(phrase, dtype=np.uint8)
                ends = np.zeros(1, dtype=np.int64), np.array([len(data)])
                one, two = (p.spans(data, p.prefixes(data), *ends) for p in (FIRST, SECOND))
                if (one.view(np.int64)[0], two.astype(np.uint32).view(np.int32)[0]) != (f["print"], f["second"]):
                    raise ValueError(f"the text at byte {f['place']} does not have the fingerprints counted for it")
                out.append((f["lang"], f["n"], phrase.decode(), f["a"]))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "n", "phrase", "a"])


def frequent_sequences(docs: DataFrame, text: str, lang: str, doc_id: str, least: int, most_bits: int = 1 << 29, bucket_bytes: int = 1 << 24,
                       limit: int = 1 << 19, flush: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """``lang, n, phrase, a`` of all sequences of one to four words found ``least`` times or more, and ``lang, n`` of all words."""
    docs, row = with_row(docs, doc_id)
    rows = docs.select(F.col(f"`{row}`").cast("long").alias("row"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").alias("text"))
    used = rows.where(F.length("text") > 0)
    spark = docs.sparkSession
    size = used.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    short = map_arrow(used, lambda b: short_counts(b, buckets, least, limit, flush), "bucket int, codes binary, counts binary")
    dealt = short.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    known = materialise(map_arrow(dealt, lambda b: frequent_codes(b, least), "place long"), "frequent-codes")
    shared = spark.sparkContext.broadcast(bloom_bits(known, most_bits))

    sequences = map_arrow(used, lambda b: counted(b, Bloom(shared.value), buckets, limit, flush), "bucket int, lang string, blob binary")
    summed = map_arrow(sequences.repartition(buckets, "bucket").sortWithinPartitions("bucket"), lambda b: often(b, least),
                       "lang string, n int, print long, second int, a long, row long, place long")
    summed = materialise(summed, "sequences")
    totals = summed.where("n = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    pointers = summed.where("n > 0").groupBy("row").agg(F.collect_list(F.struct("lang", "n", "print", "second", "a", "place")).alias("found"))
    phrases = map_arrow(used.select("row", squeezed(used, "text").alias("text")).join(pointers, "row").select("text", "found"), read_phrases, "lang string, n int, phrase string, a long")
    return materialise(phrases, "phrases"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", least: int = 30, inside: int = 80,
                 top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two to four words of every language.

    A-Z become lower case; texts are cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and
    tabs. ``a`` counts all occurrences of a phrase, ``n`` all words of the language. Of the cuts of a phrase into two
    parts found ``l`` and ``r`` times that with the least ``floor(2000000 a / (l + r))`` counts (the shortest first part
    on ties). Phrases found less than ``least`` times are left out, and those inside a longer one that is found in
    ``inside`` per cent of their occurrences or more. Order: score, ``a`` (both falling), phrase by its bytes.

    A null language is ``und``, a null or empty text has no words, repeated rows count as often as they occur, an empty
    table gives no rows, and other columns are not looked at. A very long text is worked off in parts of whole pieces.

    A phrase can be frequent only if all pairs of neighbouring words in it are. A first pass counts fingerprints of words
    and pairs, packed by bucket, and puts the frequent ones into a Bloom filter of at most 64 MB, which lets
    too many through where it is full but loses nothing. The second pass counts what passes, by fingerprints of 64 and
    32 bits, with a pointer to an occurrence. Only frequent sequences are read from their texts and compared with both.
    """
    phrases, totals = frequent_sequences(docs, text, lang, doc_id, least)
    tokens = F.split("phrase", " ")
    long = phrases.where("n >= 2").withColumn("words", tokens)

    def joined(start: object, length: object) -> object:
        return F.array_join(F.slice("words", start, length), " ")

    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("rest"))
    known = phrases.select("lang", "phrase", "a")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    score = F.expr("CAST(2000000 AS DECIMAL(8, 0)) * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    shorter = long.where("n >= 3").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("n") - 1))).withColumn(
        "i", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)))
    around = shorter.groupBy("lang", joined(F.col("i"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    wide = "DECIMAL(20, 0)"
    alone = scored.join(around, ["lang", "phrase"], "left").where(
        f"around IS NULL OR CAST(100 AS DECIMAL(3, 0)) * CAST(around AS {wide}) < CAST({inside} AS DECIMAL(3, 0)) * CAST(a AS {wide})")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    first = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
