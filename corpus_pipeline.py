"""A corpus from documents to training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import ngram_join, personal_data, quality_rules, source_mix, window_packing
from martkit.llm.common import Staging, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Spans with a lower score than this stay in the text. It is the least that a
#: confirmed span can have (an ip beside "section"), so all of them are masked.
LEAST_SCORE = 0.4
#: Packing runs beside what earlier stages hold, so it takes less at a time.
TEXT_BYTES = 2 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rule or the learned decision list rejects."""
    return quality_rules.filter_quality(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.drop_near_copies(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts and counts their characters anew."""
    masked = personal_data.mask_personal_data(docs, least=LEAST_SCORE)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources meet their weights, shuffled globally."""
    return source_mix.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training windows: a row per piece of a document."""
    return window_packing.pack_documents(docs, WORD_BPE, end_id=1, most=TEXT_BYTES)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("private_data", private_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can express neither the learner nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    staging = Staging(spark)
    for name, stage in STAGES:
        done = staging.keep(stage(spark, docs, sf_dir), f"stage-{name}")
        staging.drop(docs)  # the stage before; its rows are all in what follows
        docs = done
    return docs
