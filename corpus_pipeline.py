"""From raw documents to packed sequences: quality rules, near copies, repeated passages, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardscope.llm import catalog, decontaminate, nearcopies, packing, quality, substrings
from wardscope.llm.common import shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the quality rules and whose host does."""
    judged = quality.quality_rules(docs)
    return judged.where("kept").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar by 0.8 or more: SimHash and MinHash propose, an exact check decides."""
    return nearcopies.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; ``n_chars`` follows the text."""
    return substrings.remove_repeats(docs).selectExpr(
        *(f"cast(length(text) AS {t}) AS n_chars" if c == "n_chars" else f"`{c}`" for c, t in docs.dtypes))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.contamination(docs, catalog.table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left with their places in sequences."""
    return packing.pack(docs, catalog.tokenizer(catalog.BYTE_BPE))


STAGES = [("quality rules", keep_good), ("SimHash near-dedup", keep_one_of_near_copies), ("substring dedup", cut_repeats),
          ("benchmark decontamination", drop_benchmark_leaks), ("packing", pack)]
#: Fingerprints, chunks and token ids have no SQL form; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read again."""
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
