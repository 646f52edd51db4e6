"""A corpus pipeline: toxicity, near duplicates, repeated passages, leaks, mix.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which `run` writes as Parquet into the shared folder and
reads back as the next one's `docs`. All but the last keep the columns of
documents.

1. toxicity        rows scored 0.5 or more go
2. ngram_jaccard   of each class of near duplicates the smallest doc_id stays
3. suffix_dedup    bytes of 100-byte strings that start earlier go; texts of
                   which nothing is left go; a character cut in two goes
4. decontaminate   rows that hold a benchmark item within the error budget go
5. mixing          doc_id, source, size, source_size, target, start, taken

Rows with a null doc_id are kept by stage 2 apart from each other. `n_chars`
follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, ngram_join, suffix_dedup, toxicity
from tidemark.llm.common import sf_table, write_scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score says toxic go; learned from the labels of the kept folds."""
    model = toxicity.train(docs, sf_table(spark, sf_dir, "labels"), toxicity.learnable(5, 0))
    return toxicity.keep_clean(docs, model)


def ngram_jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays: that of the smallest doc_id."""
    return ngram_join.keep_one(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated bytes leave the texts."""
    return suffix_dedup.cut_repeats(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, sf_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each remaining document."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", ngram_jaccard_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
]

# The models and near duplicates cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
