"""Document types from URL paths: an equi-join of the path's n-grams with the vocabulary, without a UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.functions import url as U
from lodewatch.operators.sized import maybe_broadcast


def path_tokens(url):
    p = F.lower(U.path(F.substring_index(url, "?", 1)))
    return F.array_remove(F.split(F.regexp_replace(p, r"[-_/.\s]+", " "), " "), "")


def classify_library(docs: DataFrame, vocabulary: DataFrame, *, key: str = "doc_key", url: str = "document_url", longest: int = 4) -> DataFrame:
    """key, source_type, match_confidence for every row of ``docs`` (whose key is unique).

    A term counts once, by its number of words, if it stands in the path as whole tokens; the highest total wins,
    the vocabulary's first type on a tie. Confidence is high if a winning term has two words or more.
    """
    tokens = docs.select(key, path_tokens(F.col(url)).alias("t"))
    grams = lambda n: F.transform(F.sequence(F.lit(1), F.size("t") - n + 1), lambda i: F.array_join(F.slice("t", i, F.lit(n)), " "))
    every = F.flatten(F.array(*(F.when(F.size("t") >= n, grams(n)).otherwise(F.array().cast("array<string>")) for n in range(1, longest + 1))))
    exploded = tokens.select(key, F.explode(F.array_distinct(every)).alias("term"))
    scores = exploded.join(maybe_broadcast(vocabulary), "term").groupBy(key, "type_ord", "type").agg(F.sum("n_words").alias("score"), F.max("n_words").alias("longest"))
    best = scores.groupBy(key).agg(F.max(F.struct("score", (-F.col("type_ord")).alias("o"), "type", "longest")).alias("b"))
    return docs.select(key).join(best, key, "left").select(key, F.coalesce("b.type", F.lit("")).alias("source_type"), F.when(F.col("b").isNull(), "unresolved").when(F.col("b.longest") >= 2, "high").otherwise("low").alias("match_confidence"))


def classify_todo(rows: DataFrame, force: bool = False) -> DataFrame:
    return rows if force else rows.filter(F.coalesce(F.trim("match_confidence"), F.lit("")) == "")


def classify_distribution(classified: DataFrame) -> DataFrame:
    """source_type, match_confidence, n, percent of all rows."""
    counts = classified.groupBy("source_type", "match_confidence").agg(F.count("*").alias("n"))
    total = classified.agg(F.count("*").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select("source_type", "match_confidence", "n", F.round(100.0 * F.col("n") / F.col("_all"), 1).alias("percent"))
