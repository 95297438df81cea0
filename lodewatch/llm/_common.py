"""Helpers shared by the training-data operators: shared work folder, tables that cut lineage, column safety."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; what is below it goes when the application ends.

    The cluster names that folder in ``spark.checkpoint.dir``. Where that is unset a temporary folder serves, but only
    if driver and executors are one machine (``local`` masters: tests, a laptop); elsewhere it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lodewatch-"))
        base = context.getCheckpointDir()
    own = f"{base.rstrip('/')}/lodewatch-{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(own)
    store = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(folder):
        store.mkdirs(folder)
        store.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, so that a lost executor costs no more than a re-read."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator needs, under its own names; a null text counts as empty."""
    cols = [F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")]
    return docs.select(*cols, *(F.col(f"`{c}`").alias(n) for n, c in more.items()))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that a Python worker holds few texts as objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
