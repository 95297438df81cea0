"""The classifier's vocabulary: document types and their terms, as a small table whose order breaks ties."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The document types and their terms, complete and in their order. A deployment may pass a file of its own.
CORE = json.loads((Path(__file__).parent / "vocabulary.json").read_text(encoding="utf-8"))


def rows(terms: dict[str, list[str]]) -> list[tuple[int, str, str, int]]:
    return [(i, kind, term, len(term.split())) for i, (kind, own) in enumerate(terms.items()) for term in own]


def vocabulary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """type_ord, type, term, n_words. ``path`` is a JSON file any store Spark reads may hold; a bad one is an error."""
    terms = CORE
    if path:
        terms = json.loads(spark.read.text(path, wholetext=True).first()[0])
    # Literals, so that the optimizer knows the table's size and may broadcast it.
    cells = F.array(*(F.struct(F.lit(i).alias("type_ord"), F.lit(kind).alias("type"), F.lit(term).alias("term"), F.lit(n).alias("n_words")) for i, kind, term, n in rows(terms)))
    return spark.range(1).select(F.inline(cells))
