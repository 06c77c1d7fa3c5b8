"""The training-data pipeline over ``documents``: each stage works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.bpe import code_documents
from silverloom.llm.common import stored, table, words
from silverloom.llm.jaccard import keep_one
from silverloom.llm.lines import keep_good
from silverloom.llm.mixing import mix_sources, repeat_rows
from silverloom.llm.pii import find_pii, mask_pii


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines common to their source;
    ``n_chars`` follows."""
    return keep_good(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the least id."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; ``n_chars`` follows."""
    masked = mask_pii(find_pii(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mix_sources(docs, F.size(words(F.col("text"))))
    return repeat_rows(mixed).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every taken document, and whether decoding them gives its text again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    coded = code_documents(texts, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.col("text")).alias("restored"),
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("pii", personal_data),
    ("mixing sources", mixture),
    ("byte-level bpe", token_ids),
]

#: No SQL expresses the joins' components or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
