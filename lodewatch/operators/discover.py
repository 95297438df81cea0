"""Discovery of pages worth monitoring: ranked candidates and a capped greedy choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.functions import text as X
from lodewatch.functions import url as U

# Fixed value: what makes a link look like a section worth a visit.
SECTION = r"(?iu)sustainab|esg|environment|csr|responsib|climate|impact|report|annual|financ|result|filing|investor|shareholder|news|press|media|about|governance|policy|policies|ethics|compliance|publication|download|disclosur"


def crawl_candidates(links: DataFrame, most: int = 20) -> DataFrame:
    """wba_id, rank, link, text: section-like links first, then document order; one a key, the first ``most`` an entity.

    ``links`` has wba_id, pos, link, text; pos is unique inside an entity.
    """
    rows = links.withColumns({"key": U.url_key(F.col("link")), "_late": (~F.col("link").rlike(SECTION)).cast("int")}).filter("key is not null")
    once = rows.withColumn("_k", F.row_number().over(Window.partitionBy("wba_id", "key").orderBy("_late", "pos"))).filter("_k = 1")
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("wba_id").orderBy("_late", "pos")))
    return ranked.filter(F.col("rank") <= most).select("wba_id", "rank", "link", "text")


def crawl_accept(candidates: DataFrame, known: DataFrame, *, per_type: int = 2, per_entity: int = 10) -> DataFrame:
    """wba_id, place, link, type: candidates accepted in rank order.

    ``candidates`` (wba_id, rank, link, text, has_doc) are at most a few dozen an entity; ``known`` has wba_id and key. A
    known key, a type that is full and an 'other' page without a document are passed over; a key is taken only once it is
    accepted. The choice depends on what went before, so it is a fold over the entity's small sorted array.
    """
    rows = candidates.withColumns({"key": U.url_key(F.col("link")), "type": X.page_type(F.col("link"), F.col("text"))}).filter("key is not null")
    rows = rows.filter((F.col("type") != "other") | F.coalesce("has_doc", F.lit(False))).join(known.select("wba_id", "key"), ["wba_id", "key"], "left_anti")
    item = F.struct("rank", "key", "type", "link")
    grouped = rows.groupBy("wba_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = dict(grouped.dtypes)["items"]

    def step(taken: Column, x: Column) -> Column:
        full = F.size(F.filter(taken, lambda t: t["type"] == x["type"])) >= per_type
        again = F.exists(taken, lambda t: t["key"] == x["key"])
        return F.when(full | again | (F.size(taken) >= per_entity), taken).otherwise(F.concat(taken, F.array(x)))

    chosen = grouped.select("wba_id", F.posexplode(F.aggregate("items", F.array().cast(kind), step)).alias("place", "x"))
    return chosen.select("wba_id", (F.col("place") + 1).alias("place"), F.col("x.link").alias("link"), F.col("x.type").alias("type"))


def discovered_rows(accepted: DataFrame, names: DataFrame) -> DataFrame:
    """The pages to insert: link_name, wba_id, url, type, monitor, frequency, source."""
    return accepted.join(names, "wba_id").select(F.concat("company_name", F.lit(" — "), X.label_for(F.col("type"))).alias("link_name"), "wba_id", F.col("link").alias("url"), "type", F.lit(True).alias("monitor"), X.frequency_for(F.col("type")).alias("frequency"), F.lit("sweep").alias("source"))
