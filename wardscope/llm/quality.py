"""Quality rules with a verdict on whole hosts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardscope.llm.common import apply_arrow, free_name, materialise, with_struct

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text, the first occurrence included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    keys = codes[:n]
    for k in range(1, width):  # numbered anew after every word, so that the product always fits
        if k > 1:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(numbers) + codes[k:n + k]
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    ends = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(count[place] > 1)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(ends[:-1])))


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five counts of one text; a null has none of anything."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    blanks = len(raw) - len(raw.translate(None, WHITE))
    return (len(words), len(text or "") - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def _counts(texts: pa.Array) -> pa.Array:
    rows = [text_counts(t.as_py()) for t in texts]
    columns = zip(*rows) if rows else [[]] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_verdicts(rows: DataFrame, host: str, max_rate: float, prior_limit: float = 1e6) -> DataFrame:
    """One row per host: ``host, n_docs, n_failed, host_rate, host_kept``.

    The failure rate of a host is shrunk towards the rate of all: a beta prior with the mean of all documents and the
    spread that the hosts' rates show beyond that of chance (method of moments) counts as so many further documents.
    Its weight is at least one document; hosts that differ by no more than chance get the weight ``prior_limit``.
    The prior rests on all hosts and is three numbers.
    """
    hosts = materialise(rows.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")), "hosts")
    total = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.count(F.lit(1)),
                      F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs"))).first()
    docs, failed, count, squares = total[0] or 1, total[1] or 0, total[2], total[3] or 0.0
    mean = failed / docs
    even = mean * (1 - mean)
    spread = squares / docs - mean * mean - even * count / docs
    weight = min(max(even / spread - 1, 1.0), prior_limit) if spread > 0 else prior_limit
    rate = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", F.col("host_rate") <= max_rate)


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None, min_words: int = 50,
                  max_repeat_percent: int = 50, max_host_rate: float = 0.5) -> DataFrame:
    """Counts, rule failures and verdicts of documents, with the columns ``carry`` (all by default).

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate, kept`` (columns of these
    names are replaced). A document is kept if it meets the rules itself and the shrunk failure rate of its host is at
    most ``max_host_rate``. A null or empty text has no words and fails. A document without a host is judged by its own
    rules alone and ``host_rate`` is null. Repeated rows count and return as often as they occur; an empty table gives
    no rows. The counts are taken once; what failed is added up per host inside the tasks before it is exchanged, and
    the verdicts, one row per host, meet the documents in a join whose uneven side can be split.
    """
    keep = docs.columns if carry is None else carry
    wanted = list(dict.fromkeys([*keep, host]))
    rows = with_struct(docs, apply_arrow(docs, _counts, ", ".join(f"{c} long" for c in COUNTS), text), COUNTS)
    kept = [c for c in wanted if c in rows.columns]
    rows = materialise(rows.select(*kept, *COUNTS).withColumn("base_failed", base_failed(min_words, max_repeat_percent)), "quality")
    hosts = host_verdicts(rows, host, max_host_rate)
    key, rate, verdict = (free_name(rows, n) for n in ("verdict_host", "verdict_rate", "verdict_kept"))
    joined = rows.join(hosts.select(F.col("host").alias(key), F.col("host_rate").alias(rate), F.col("host_kept").alias(verdict)),
                       F.col(host) == F.col(key), "left")
    shown = [c for c in keep if c in kept and c.lower() not in ("base_failed", "host_rate", "kept")]
    return joined.select(*shown, *COUNTS, "base_failed", F.col(rate).alias("host_rate"),
                         (~F.col("base_failed") & F.coalesce(F.col(verdict), F.lit(True))).alias("kept"))
