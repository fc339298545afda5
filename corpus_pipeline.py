"""The corpus pipeline: documents to token ids in five stages.

Every stage works on all that its predecessor kept. Stages return the columns of ``documents``; the
last returns the ids of each document's tokens. What a stage returns is written as Parquet to the
shared scratch folder and read again as the next stage's input.

Stages, and how they treat odd rows: see the operators' own descriptions. In short, rows
without words go in the first stage, ids may be null or repeat, and all other columns
of the documents, whatever their names, are carried through the filtering stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.bpe_trie import bpe_encode
from cardlake.llm.budget_mix import mix
from cardlake.llm.jaccard_tiles import keep_one_per_group
from cardlake.llm.queries import MIX_SEED, MIX_WEIGHTS, source_domain, tokenizer_path
from cardlake.llm.secret_index import redact
from cardlake.llm.tables import table, written
from cardlake.llm.weak_labels import quality_filter

#: The share of the tokens that reach the mixing stage which it hands on, each at most once.
PIPELINE_SHARE = 0.8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality_filter(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, Jaccard of 0.8 or more)."""
    return keep_one_per_group(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced; ``n_chars`` follows the text."""
    clean = redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    length = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fit the token budgets of their domain, language and source."""
    return mix(docs, source_domain(), PIPELINE_SHARE, epochs=1, weights=MIX_WEIGHTS, seed=MIX_SEED).select("doc.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe_encode(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL cannot fit the quality model; tests/llm/test_quality_quotes_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
