"""Corpus pipeline over ``documents``: language ID, exact dedup, near-duplicate join,
PII surrogates, packing.

``STAGES`` lists the stages in order. Each function takes (spark, docs, sf_dir);
what it returns is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.common import written
from greenledger.llm.exact_dedup import drop_copies
from greenledger.llm.langid import UNKNOWN, identify, labelled_sample
from greenledger.llm.ngram_join import drop_near_copies
from greenledger.llm.packing import pack
from greenledger.llm.pii import replace_pii
from greenledger.llm.queries import PII_KEY


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text or no letter. The language found
    becomes the label of the others, missing and wrong ones included; if
    there is nothing to learn from, labels stay as they are."""
    sample = labelled_sample(docs)
    if not sample:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, sample).filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but the first of identical texts (white space aside)."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all but one document of each class of near-duplicates."""
    return drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; ``n_chars`` follows the new text."""
    return replace_pii(docs, PII_KEY).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into training sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                public_tokenizers.PATTERN)


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii),
          ("packing", packing)]

#: Language models, surrogates and tokenizers can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
