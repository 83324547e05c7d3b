"""A training corpus from raw documents: each stage works on what the one before it kept.

quality rules -> near-duplicates -> repeated passages -> personal data -> packing.
A stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import minhash, packing, pii, quality, repeats
from reviewmill.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a repeated passage: of any 51 words, 99 in 100 take 240 or more.
PASSAGE = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    return quality.keep_good(docs.select(*COLUMNS), quality.POLICIES["v1"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicate(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of PASSAGE bytes or more that stand elsewhere too."""
    cleaned = repeats.remove_repeats(docs.select(*COLUMNS), length=PASSAGE)
    return cleaned.select("row.*", "text").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens, with their ids."""
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("personal_data", personal_data), ("packing", packed)]

#: SQL can't express the packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
