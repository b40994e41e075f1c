"""A corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; ``run`` applies them to ``documents``
and writes each result as Parquet before the next stage reads it. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nearfield.llm import byte_bpe, decontamination, jaccard_join, quality_rules, suffix_dedup
from nearfield.llm.common import materialize, prepare, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    prepare(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id."""
    prepare(spark)
    return jaccard_join.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes or more that a document with a smaller id has."""
    prepare(spark)
    return suffix_dedup.cut_repeats(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    return decontamination.leave_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``n_tokens``, ``token_ids`` and ``decoded``, the text decoded from the ids."""
    import public_tokenizers

    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return byte_bpe.encode_decode(docs, path, byte_bpe.build_lexicon(docs, path)).drop("text")


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeats),
          ("benchmark decontamination", benchmark), ("BPE encoding and decoding", tokens)]

# Random forests, sketches and merges have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return docs
