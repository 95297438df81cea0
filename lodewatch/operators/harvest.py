"""Harvest: links seen on pages become library rows, one an entity and document."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.functions import url as U

TYPES = ("reports_hub", "sustainability_page", "sustainability_report", "investor_relations", "policies")


def _of_types(rows: DataFrame, types) -> DataFrame:
    return rows.filter(F.lower(F.trim(F.coalesce("type", F.lit("")))).isin(*types))


def harvest_pages(pages: DataFrame, types=TYPES) -> DataFrame:
    return _of_types(pages.filter(F.coalesce("monitor", F.lit(False))), types)


def harvest_explode(links: DataFrame, pages: DataFrame | None = None, *, types=TYPES) -> DataFrame:
    """rec_id, wba_id, type, document_url, found_on, pos: PDF-shaped links, and pages that are PDFs themselves (pos last).

    ``links`` has rec_id, wba_id, type, page_url, document_url and, if their order matters, pos. ``pages`` has
    rec_id, wba_id, type, url and perhaps is_pdf. Rows with a blank URL are dropped. Links alone may bring ``key``, the
    key of the URL to fetch, and keep it.
    """
    pos = F.col("pos") if "pos" in links.columns else F.lit(0)
    key = ["key"] if "key" in links.columns and pages is None else []
    seen = _of_types(links, types).select("rec_id", "wba_id", "type", U.fetchable(F.col("document_url")).alias("document_url"), F.col("page_url").alias("found_on"), pos.alias("pos"), *key)
    seen = seen.filter("document_url <> ''").filter(U.is_pdf_url(F.col("document_url")))
    if pages is None:
        return seen
    flagged = F.lower(F.trim(F.col("is_pdf").cast("string"))).isin("checked", "true", "1", "yes") if "is_pdf" in pages.columns else F.lit(False)
    own = _of_types(pages, types).filter(F.coalesce(flagged, F.lit(False)) | U.is_pdf_url(F.col("url"))).select("rec_id", "wba_id", "type", U.fetchable(F.col("url")).alias("document_url"), F.col("url").alias("found_on"), F.lit(2_147_483_647).alias("pos"))
    return seen.unionByName(own.filter("document_url <> ''"))


def harvest_build(found: DataFrame, *, reports_only: bool = False) -> DataFrame:
    """One row a library id, the first of page order (rec_id), then link order, then URL."""
    rows = found.filter(U.looks_like_report(F.col("document_url"))) if reports_only else found
    first = Window.partitionBy("library_id").orderBy("rec_id", "pos", "document_url")
    key = F.col("key") if "key" in rows.columns else U.url_key_total(F.col("document_url"))
    keyed = rows.withColumn("library_id", U.owned_id(U.owner(F.col("wba_id")), key, 10)).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return keyed.select("library_id", "wba_id", "document_url", "found_on", F.col("type").alias("page_type"), U.year_of(F.col("document_url")).alias("doc_year"), U.link_id(F.col("wba_id"), F.col("found_on")).alias("source_link_id"))


def shared_docs(rows: DataFrame, at_least: int = 5) -> DataFrame:
    """key, n: documents under ``at_least`` distinct entities."""
    return rows.groupBy(U.url_key_total(F.col("document_url")).alias("key")).agg(F.count_distinct(F.coalesce("wba_id", F.lit(""))).alias("n")).filter(F.col("n") >= at_least)


def shared_docs_guard(rows: DataFrame, at_least: int = 5) -> DataFrame:
    """Library rows without the shared documents."""
    return rows.withColumn("key", U.url_key_total(F.col("document_url"))).join(shared_docs(rows, at_least).select("key"), "key", "left_anti").drop("key")


def harvest_counts(rows: DataFrame, by: str) -> DataFrame:
    """``by``, n: library rows by entity or page type, before the guard."""
    return rows.groupBy(by).agg(F.count("*").alias("n"))


def top_entities(rows: DataFrame, k: int = 10) -> DataFrame:
    return harvest_counts(rows, "wba_id").orderBy(F.desc("n"), "wba_id").limit(k)


def scheme_stats(links: DataFrame, *, types=TYPES) -> DataFrame:
    """One row: PDF-shaped entries with a scheme and bare ones, repeats counted."""
    rows = _of_types(links, types).filter(U.is_pdf_url(U.fetchable(F.col("document_url"))))
    whole = F.trim("document_url").rlike("^https?://")
    return rows.agg(F.count_if(whole).alias("fetchable"), F.count_if(~whole).alias("bare"))


def resolve_source_page(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """``rows`` with source_page, the record of the page at found_on (the last record of a URL wins); NULL if unknown."""
    by_url = pages.groupBy(U.url_key_total(F.col("url")).alias("_key")).agg(F.max("rec_id").alias("source_page"))
    return rows.withColumn("_key", U.url_key_total(F.col("found_on"))).join(by_url, "_key", "left").drop("_key")


def harvest_incremental(rows: DataFrame, existing: DataFrame, run_date: dt.date, *, full: bool = False) -> DataFrame:
    """library_id, document_url, first_seen, op: what to create or update; unchanged rows are left out.

    ``existing`` has library_id, document_url and first_seen, which is kept where it is known.
    """
    old = existing.select("library_id", F.col("document_url").alias("_url"), F.col("first_seen").alias("_first"), F.lit(True).alias("_there"))
    op = F.when(F.col("_there").isNull(), "create").when(F.lit(full) | ~F.col("document_url").eqNullSafe(F.col("_url")), "update")
    joined = rows.join(old, "library_id", "left").withColumn("op", op).filter("op is not null")
    return joined.select("library_id", "document_url", F.coalesce("_first", F.lit(run_date)).alias("first_seen"), "op")
