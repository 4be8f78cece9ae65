"""Training-corpus pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each result to the
shared scratch folder and reads it back for the next stage. The language
model and the token ids have no SQL form, so there is no oracle; the tests
hold the stages against brute force.

A stage is computed by its caller, so the limit that the first two set on
Arrow batches outlasts them; ``run`` restores it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow.llm.common import limit_batches, materialise, small_batches
from tickflow.llm.exact_dedup import exact_dedup
from tickflow.llm.langid import keep_identified
from tickflow.llm.mixing import mix
from tickflow.llm.ngram_join import keep_one
from tickflow.llm.packing import pack_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without a letter or a clear language go."""
    limit_batches(spark)
    return keep_identified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    limit_batches(spark)
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 over five-word shingles, the one with the smallest id."""
    return keep_one(docs, width=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources repeated up to twice."""
    return mix(docs, repetition=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece."""
    return pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
