"""A corpus pipeline of five stages: quality classifier, near-duplicates, decontamination, secret scan, packing.

Every stage takes ``docs`` with the columns of ``documents`` (and any others, whatever their names), and works on all its
rows: null and empty texts, null and repeated ids, repeated rows and empty tables have the results that each stage
states; ties have none that matter, since no stage orders rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodewatch.llm import decontam, neardup, packing, quality_model, secrets
from lodewatch.llm._common import work_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, scores 0.5 or more.

    A null or empty text is scored like a text without words; repeated rows get one score each; without labels every
    document scores 0.5 and stays.
    """
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id.

    Null and empty texts link with nothing and stay; rows without an id stay; all rows of an id that stays, stay.
    """
    gone = neardup.near_duplicates(docs, words=5, percent=80).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark; those that are mostly benchmark go.

    A null text becomes empty and stays; repeated rows are each cleaned; an empty benchmark leaves all as they are.
    """
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, max_coverage=0.5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced unless many owners have copied them.

    A null text stays null; a null source is one owner; no row goes.
    """
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 2048 tokens.

    A null or empty text is one piece of one token, its end id; repeated rows have pieces of their own.
    """
    return packing.pack(docs, length=2048).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secret_scan), ("packing", pack)]

#: Learned scores, sketches and packing have no SQL form; a test holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
