"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardscope.llm import decontaminate, hardnegatives, html, langid, packing, phrases, quality, simhash, substrings, suffixes, tokencounts, tokenfiles, warc
from wardscope.llm.common import shared_folder

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, statement: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = build
        if statement:
            ORACLES[name] = statement
        return build
    return register


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op6_quality_rules", r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t)),
win AS (SELECT r, i, w || chr(1) || lead(w, 1) OVER s || chr(1) || lead(w, 2) OVER s AS g FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win WHERE g IS NOT NULL) WHERE c > 1),
rw AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY r),
wc AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM t)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (SELECT doc_id, source, cast(coalesce(n_words, 0) AS bigint) AS n_words, cast(coalesce(word_chars, 0) AS bigint) AS word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols, cast(coalesce(n_dup_lines, 0) AS bigint) AS n_dup_lines,
        cast(coalesce(n_repeat_words, 0) AS bigint) AS n_repeat_words FROM t LEFT JOIN wc USING (r) LEFT JOIN rw USING (r) LEFT JOIN ln USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT sum(k) / sum(n) AS m, sum(k * k / n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n))
        - (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * count(*) / sum(n) AS spread FROM h),
q AS (SELECT m, CASE WHEN spread > 0 THEN least(greatest(m * (1 - m) / spread - 1, 1), 1e6) ELSE 1e6 END AS weight FROM p),
v AS (SELECT source, (k + m * weight) / (n + weight) <= 0.5 AS good FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(good, true) AS kept
FROM f LEFT JOIN v USING (source)""")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return quality.quality_rules(docs, carry=["doc_id"]).drop("host_rate")


@query("op9_simhash_groups")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op7_substring_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_benchmark_decontamination")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, folder, "benchmark")).drop("text")


@query("op1_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"), tokenizer(BYTE_BPE))


@query("op3_warc_bundles")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    tokenfiles.write_ids(table(spark, folder, "documents").select("doc_id", "text"), path, tokenizer(WORD_BPE))
    return tokenfiles.read_ids(spark, path)


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.section_tokens(table(spark, folder, "documents").select("doc_id", "text"), tokenizer(BYTE_BPE))


# The pages of the test tables hold their text in one article of headings and paragraphs, which plain SQL can cut out.
@query("op5_main_text", r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(body, '</?(?:h1|p)>'), lambda x: trim(regexp_replace(regexp_replace(replace(replace(
    regexp_replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS parts FROM a)
SELECT page_id, url, coalesce(array_to_string(parts, chr(10)), '') AS text, cast(length(coalesce(array_to_string(parts, chr(10)), '')) AS bigint) AS n_chars FROM b""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op11_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS bigint) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS int) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("op12_suffix_dedup")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_earlier(table(spark, folder, "documents").select("doc_id", "text")).drop("kept")


@query("op13_phrases", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(list_slice(ws, i, i + m - 1), ' '))) AS phrase
      FROM w, range(1, 5) AS k(m)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND a >= 30),
cut AS (SELECT c.*, k, array_to_string(list_slice(ws, 1, k), ' ') AS head, array_to_string(list_slice(ws, k + 1, m), ' ') AS rest FROM c, range(1, 4) AS j(k) WHERE k < m),
s AS (SELECT cut.*, x.a AS l, y.a AS r, cast(2000000::hugeint * cut.a // (x.a + y.a) AS bigint) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (SELECT lang, array_to_string(list_slice(ws, i, i + j - 1), ' ') AS phrase, max(a) AS around
      FROM c, range(2, 4) AS p(j), range(1, 4) AS q(i) WHERE j < m AND i + j - 1 <= m GROUP BY ALL),
n AS (SELECT lang, cast(sum(a) AS bigint) AS n FROM f WHERE m = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN u USING (lang, phrase) JOIN n USING (lang) WHERE around IS NULL OR 100::hugeint * around < 80::hugeint * a QUALIFY rank <= 2000""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("doc_id", "text", "lang"))
