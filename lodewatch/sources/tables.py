"""Reading and writing of tables: Parquet, CSV, fetched pages and files; update plans and how they are applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_project(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the named columns reach the scan's read schema."""
    return spark.read.parquet(path).select(*columns)


def scan_filter(spark: SparkSession, path: str, condition: str) -> DataFrame:
    """Rows that meet a SQL condition; what Parquet can test is pushed to the scan."""
    return spark.read.parquet(path).filter(condition)


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV export with a header, quoted line ends and perhaps a byte-order mark; every column is text."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", maxCharsPerColumn=-1)
    return df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))


def scan_fetch_log(spark: SparkSession, path: str, schema: str = "url string, final_url string, http_status int, redirected boolean, error_kind string, lane string, html string, visible_text string, fetched_at timestamp") -> DataFrame:
    """Pages that a crawler has fetched or rendered. Executors never fetch."""
    return spark.read.schema(schema).parquet(path)


def scan_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Downloaded files: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def update_plan(current: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, columns, _op: 'insert' for new keys, 'update' for rows that differ (nulls compare equal), unchanged rows left out."""
    old = current.select(key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_there"))
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    op = F.when(F.col("_there").isNull(), "insert").when(differs, "update")
    return target.select(key, *columns).join(old, key, "left").withColumn("_op", op).filter("_op is not null").select(key, *columns, "_op")


def apply_plan(current: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """``current`` after the plan; a full outer join, since Parquet tables have no MERGE. Columns the plan lacks stay."""
    changed = [c for c in plan.columns if c not in (key, "_op")]
    new = plan.select(key, *(F.col(c).alias(f"_{c}") for c in changed), F.lit(True).alias("_in"))
    joined = current.join(new, key, "full_outer")
    return joined.select(*(F.when(F.col("_in"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in current.columns))


def upsert(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``current`` with ``rows`` put in by key; a key that comes twice in ``rows`` must be made single before."""
    return apply_plan(current, update_plan(current, rows, key, [c for c in rows.columns if c != key]), key)


def attach_plan(rows: DataFrame) -> DataFrame:
    """rec_id, url, filename: files to attach; the upload itself is not Spark's work."""
    from lodewatch.functions.url import filename_for

    return rows.select("rec_id", F.col("document_url").alias("url"), filename_for(F.col("document_url"), F.col("library_id")).alias("filename"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
