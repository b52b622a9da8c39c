"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, with_library, with_struct

ORDER = 4
_START = b"\n" * ORDER
MODEL = "lang string, depth int, kind int, code long, bits double"


def grams(texts: list[bytes], depth: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the texts with the ``depth`` bytes before it as one number, and where each text begins."""
    data = np.frombuffer(b"".join(_START + t for t in texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    value = np.zeros(max(len(data) - ORDER, 0), dtype=np.int64)
    for k in range(ORDER - depth, ORDER + 1):
        value = (value << 8) | data[k:k + len(value)]
    stops = np.cumsum(lengths + ORDER)
    own = np.ones(len(value), dtype=bool)
    for s in stops[:-1].tolist():  # windows that begin before a text and end in the bytes put in front of it
        own[s - ORDER:s] = False
    return value[own], np.concatenate(([0], np.cumsum(lengths)[:-1]))


def tree(texts: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Code lengths in bits of a context tree, frozen: (depth, kind, codes, bits) with kind 0 for symbols, 1 for escapes.

    After a context seen ``t`` times with ``d`` different symbols a symbol seen ``c`` times takes ``-log2(c / (t + d))`` bits and
    the escape to the context shorter by one ``-log2(d / (t + d))``.
    """
    out = []
    for depth in range(ORDER + 1):
        codes, seen = np.unique(grams(texts, depth)[0], return_counts=True)
        contexts, at, kinds = np.unique(codes >> 8, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=seen, minlength=len(contexts))
        out.append((depth, 0, codes, -np.log2(seen / (total + kinds)[at])))
        out.append((depth, 1, contexts, -np.log2(kinds / (total + kinds))))
    return out


class Trees:
    """Frozen context trees of several languages."""

    def __init__(self, rows: pa.Table) -> None:
        self.parts: dict[str, dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]] = {}
        lang, depth, kind = (np.array(rows.column(c).to_pylist()) for c in ("lang", "depth", "kind"))
        code, bits = rows.column("code").to_numpy(), rows.column("bits").to_numpy()
        for name in sorted(set(lang.tolist())):
            for d in range(ORDER + 1):
                for k in (0, 1):
                    own = np.flatnonzero((lang == name) & (depth == d) & (kind == k))
                    own = own[np.argsort(code[own])]
                    self.parts.setdefault(name, {})[d, k] = (code[own], bits[own])
        self.languages = sorted(self.parts)

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, bits = table
        if not len(keys):
            return np.zeros(len(codes), dtype=bool), np.zeros(len(codes))
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        return keys[at] == codes, bits[at]

    def bits(self, codes: np.ndarray, language: str) -> np.ndarray:
        """Code length of each byte after its context; 8 bits where even the empty context does not know it."""
        parts, total, open_ = self.parts[language], np.zeros(len(codes)), np.arange(len(codes))
        for depth in range(ORDER, -1, -1):
            own = codes[open_] & ((1 << 8 * (depth + 1)) - 1)
            hit, cost = self._find(parts[depth, 0], own)
            total[open_[hit]] += cost[hit]
            open_, own = open_[~hit], own[~hit]
            known, cost = self._find(parts[depth, 1], own >> 8)
            total[open_[known]] += cost[known]
        total[open_] += 8
        return total

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language with the shortest code and its share of the likelihood; ``und`` for null or no letter."""
        plain = [(t or "").encode() for t in texts]
        codes, starts = grams(plain)
        unique, at = np.unique(codes, return_inverse=True)
        sums = np.zeros((len(texts), len(self.languages)))
        filled = np.array([len(t) > 0 for t in plain])
        for k, name in enumerate(self.languages):
            if len(codes):
                sums[filled, k] = np.add.reduceat(self.bits(unique, name)[at], starts[filled])
        out = []
        for text, row in zip(texts, sums):
            if not len(row) or not any(map(str.isalpha, text or "")):
                out.append(("und", 0.0))
            else:
                best = int(row.argmin())
                out.append((self.languages[best], float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum())))
        return out


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, doc_id: str, text: str, lang: str, sample_docs: int = 300, sample_chars: int = 50_000,
                    max_languages: int = 1000) -> DataFrame:
    """Bounded sample ``lang, text``: texts are cut into pieces of ``sample_chars`` characters, and of each language the
    ``sample_docs`` pieces with the smallest hash of id and place are taken (of equal ones by the hash of the piece).

    Hashes alone find the limit of each language, so that only pieces below it are exchanged, and of pieces of one hash (rows
    that share an id) no more than ``sample_docs`` a task. Rows without text, language or id give nothing.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    starts = F.sequence(F.lit(0), F.greatest(F.length("text") - 1, F.lit(0)), F.lit(sample_chars))
    rows = rows.withColumn("at", F.explode(starts)).withColumn("hash", F.xxhash64("doc_id", "at"))
    order = Window.partitionBy("lang").orderBy("hash")
    limits = dict(rows.select("lang", "hash").withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_docs)
                  .groupBy("lang").agg(F.max("hash")).limit(max_languages + 1).collect())
    if len(limits) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not limits:
        return rows.select("lang", "text").limit(0)
    highest = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    pieces = rows.where(F.col("hash") <= highest[F.col("lang")]).select("lang", "hash", F.expr(f"substring(text, at + 1, {sample_chars})").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", F.xxhash64("text")))
    return pieces.withColumn("place", place).where(F.col("place") <= sample_docs).select("lang", "text")


def fit(docs: DataFrame, doc_id: str, text: str, lang: str, **bounds: int) -> Trees:
    """Trees of all languages from their ``training_sample``, each counted in a task of its own; the sample bounds the model."""
    sample = training_sample(docs, doc_id, text, lang, **bounds)

    def count(table: pa.Table) -> pa.Table:
        parts = tree([t.encode() for t in table.column("text").to_pylist()])
        return pa.concat_tables([pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(codes), pa.string()),
                                           "depth": pa.array([d] * len(codes), pa.int32()), "kind": pa.array([k] * len(codes), pa.int32()),
                                           "code": pa.array(codes, pa.int64()), "bits": pa.array(bits, pa.float64())}) for d, k, codes, bits in parts])

    with_library(docs.sparkSession)
    return Trees(sample.groupBy("lang").applyInArrow(count, MODEL).toArrow())


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **sample: int) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score`` (replaced if there).

    For each value of ``lang`` a tree of byte contexts up to four bytes long is learned from documents with a language that
    are not held out (those whose ``crc32`` of the id as text is 2 modulo 4 are), see ``training_sample``. A whole text is coded with
    each frozen tree, escaping to shorter contexts; the shortest code wins (the first in alphabetic order of equals), and
    ``score`` is its share of the likelihood of all. A null text or one without letters is ``und`` with score 0, as is all if
    nothing could be learned. A null id is not held out and not learned from. Repeated rows return as often as they occur.
    """
    train = docs.where(~held_out(doc_id))
    model = docs.sparkSession.sparkContext.broadcast(fit(train, doc_id, text, lang, **sample))  # bounded by the sample

    def predict(texts: pa.Array) -> pa.Array:
        out: list[tuple[str, float]] = []
        held, size = [], 0
        for t in texts:
            held.append(t.as_py())
            size += len(held[-1] or "")
            if size > 2_000_000:
                out += model.value.predict(held)
                held, size = [], 0
        out += model.value.predict(held) if held else []
        names, scores = zip(*out) if out else ((), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    rows = with_struct(docs, apply_arrow(docs, predict, "lang_pred string, score double", text), ["lang_pred", "score"])
    return rows.withColumn("held_out", held_out(doc_id))
