"""The corpus pipeline: five stages, each over all that the one before kept.

quality -> exact copies -> near copies -> benchmark contamination -> mix. The first four keep the columns of documents;
the mix adds each document's place. Every stage is written as Parquet and read again by the next one; what a stage wrote on
its way, and what the one before it wrote, is deleted then.

Defined results: empty tables and tables without labels pass through (a classifier without labels rejects nothing); rows
with null or empty texts are judged as such by every stage; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import queries
from marlstone.llm._shared import release, settle
from marlstone.llm.decontaminate import decontaminate
from marlstone.llm.exact_dedup import exact_dedup
from marlstone.llm.jaccard_join import keep_one_per_class
from marlstone.llm.mixing import mix_sources
from marlstone.llm.quality import filter_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels of its input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_quality(docs, queries.quality_model(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents, the one with the smallest id; documents without words all stay."""
    return keep_one_per_class(docs, n=5, percent=75)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than 5 % lie in passages of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=13, share=0.05)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in a mix of the sources."""
    return mix_sources(docs, block_docs=16)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", benchmark), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = docs
        docs = settle(lambda stage=stage, before=before: stage(spark, before, sf_dir), f"pipeline-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained network has no SQL twin; tests hold each stage against a brute-force version.
ORACLE_SQL = None
