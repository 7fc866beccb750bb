"""The corpus pipeline: documents to token ids, one operator a stage.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelex.llm import bpe, common, exact_dedup, language_id, mixing, ngram_join


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; all others are identified by their whole text, which fills a missing
    ``lang`` and corrects one that the text clearly contradicts."""
    return language_id.accepted(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A to Z in either case) the row with the largest doc_id stays."""
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, directly or through others, the one
    with the smallest doc_id stays."""
    return ngram_join.survivors(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights: a document comes as often as the mix takes it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sized = docs.withColumn("__size", mixing.word_count("text"))
    drawn = sized.withColumn("__draw", mixing.drawn("doc_id", F.col("__size"), "text"))
    weighed = mixing.with_quality(drawn, labels, name="__weight")
    return mixing.mixture(
        weighed, carry=tuple(docs.columns), size_col="__size", quality_col="__weight",
        draw_col="__draw",
    )


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix, with the language of the first stage."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, ranks, carry=("lang",)).select("*", "row.lang").drop("row")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: Support vector machines and keyed sampling have no SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage wrote on its way goes when its result is written, and that
    result when the next stage's is: no more than two stages' tables are kept at a time."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    *stages, (_, last) = STAGES
    for name, stage in stages:
        held = set(common.named())
        docs = common.saved(stage(spark, docs, sf_dir), name)
        *passing, result = [folder for folder in common.named() if folder not in held]
        common.release(spark, before + passing)
        before = [result]
    return last(spark, docs, sf_dir)
