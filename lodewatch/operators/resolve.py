"""Key-resolution joins, reconciliation, shared pages and domains. Changes come back as update plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.functions import text as X
from lodewatch.functions import url as U
from lodewatch.operators.sized import maybe_broadcast, settled


def _company_ids(companies: DataFrame) -> DataFrame:
    """wba_id, company_rec: the last record of an id wins."""
    rows = companies.select(U.blank_to_null(F.col("wba_id")).alias("wba_id"), "rec_id").filter("wba_id is not null")
    return rows.groupBy("wba_id").agg(F.max("rec_id").alias("company_rec"))


def link_companies(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """rec_id, company_rec: the plan for rows whose entity has a company."""
    return rows.select("rec_id", U.blank_to_null(F.col("wba_id")).alias("wba_id")).join(maybe_broadcast(_company_ids(companies)), "wba_id").select("rec_id", "company_rec")


def link_companies_orphans(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """wba_id: distinct non-blank entities without a company."""
    return rows.select(U.blank_to_null(F.col("wba_id")).alias("wba_id")).filter("wba_id is not null").join(_company_ids(companies), "wba_id", "left_anti").distinct()


def link_documents(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """rec_id, source_page: documents with a source link id and the page that has it; the last page of an id wins."""
    ids = pages.groupBy("link_id").agg(F.max("rec_id").alias("source_page"))
    return docs.filter("source_link_id is not null").join(settled(ids), docs.source_link_id == F.col("link_id")).select(docs.rec_id, "source_page")


def link_documents_missing(docs: DataFrame, pages: DataFrame, times: str | None = None) -> DataFrame:
    """One row: how many documents have a source link id that no page has.

    ``times`` is the column that says for how many documents a row stands, where they come counted; by default it is one.
    """
    ids = pages.select(F.col("link_id").alias("source_link_id")).distinct()
    n = F.coalesce(F.sum(times), F.lit(0).cast("long")) if times else F.count("*")
    return docs.filter("source_link_id is not null").join(settled(ids), "source_link_id", "left_anti").agg(n.alias("missing"))


def _analysts(companies: DataFrame) -> DataFrame:
    """wba_id (trimmed), _want: one row an entity; the analyst of its last record."""
    rows = companies.select(U.blank_to_null(F.col("wba_id")).alias("wba_id"), "rec_id", "analyst").filter("wba_id is not null")
    return rows.groupBy("wba_id").agg(F.max_by("analyst", "rec_id").alias("_want"))


def reconcile_analyst(rows: DataFrame, companies: DataFrame, *, changes_only: bool = True) -> DataFrame:
    """rec_id, outcome, analyst (wanted): set, fixed or cleared where row and company differ; ok only if asked for.

    Ids are compared without blanks around them; rows with none, or with one no company has, are left alone.
    """
    have, want = F.col("analyst"), F.col("_want")
    outcome = F.when(have.eqNullSafe(want), "ok").when(want.isNull(), "cleared").when(have.isNull(), "set").otherwise("fixed")
    own = rows.select("rec_id", "analyst", U.blank_to_null(F.col("wba_id")).alias("wba_id"))
    joined = own.join(maybe_broadcast(_analysts(companies)), "wba_id").select("rec_id", outcome.alias("outcome"), want.alias("analyst"))
    return joined.filter("outcome <> 'ok'") if changes_only else joined


def reconcile_stats(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """outcome, n: rows by outcome, and under ``orphans`` the distinct entities that no company has."""
    counts = reconcile_analyst(rows, companies, changes_only=False).groupBy("outcome").agg(F.count("*").alias("n"))
    return counts.unionByName(link_companies_orphans(rows, companies).agg(F.lit("orphans").alias("outcome"), F.count("*").alias("n")))


def _page_key(pages: DataFrame):
    """The column ``key`` where the table has one, else made of the URL."""
    return F.col("key") if "key" in pages.columns else U.url_key(F.col("url"))


def shared_pages(pages: DataFrame, at_least: int = 3) -> DataFrame:
    """key, n: page URLs under ``at_least`` distinct entities; a blank entity counts as one."""
    keyed = pages.select(_page_key(pages).alias("key"), F.coalesce("wba_id", F.lit("")).alias("e")).filter("key is not null")
    return keyed.groupBy("key").agg(F.count_distinct("e").alias("n")).filter(F.col("n") >= at_least)


def unmonitor_shared(pages: DataFrame, at_least: int = 3, among: DataFrame | None = None) -> DataFrame:
    """rec_id, monitor (false): monitored pages whose URL is shared.

    ``among`` are the entities and URLs to count where they are known without repeats; by default all of ``pages``.
    """
    on = pages.filter(X.truthy(F.col("monitor"))).select("rec_id", _page_key(pages).alias("key"))
    shared = shared_pages(pages if among is None else among, at_least).select("key")
    return on.join(settled(shared), "key", "left_semi").select("rec_id", F.lit(False).alias("monitor"))


def domain_vote(pages: DataFrame) -> DataFrame:
    """wba_id, domain: the first homepage's domain, else the most frequent one (the first seen on a tie)."""
    rows = pages.select(U.blank_to_null(F.col("wba_id")).alias("wba_id"), U.registrable_domain(F.col("url")).alias("domain"), "type", "rec_id").filter("wba_id is not null and domain <> ''")
    counts = rows.groupBy("wba_id", "domain").agg(F.count("*").alias("n"), F.min("rec_id").alias("first"), F.min(F.when(F.col("type") == "homepage", F.col("rec_id"))).alias("home"))
    rank = Window.partitionBy("wba_id").orderBy(F.col("home").isNull(), "home", F.desc("n"), "first")
    return counts.withColumn("_r", F.row_number().over(rank)).filter("_r = 1").select("wba_id", "domain")


def logo_plan(companies: DataFrame, pages: DataFrame, template: str = "https://logo.example.org/{domain}") -> DataFrame:
    """rec_id, url, filename: the logo to fetch for companies with a domain."""
    return companies.join(domain_vote(pages), "wba_id").select("rec_id", F.replace(F.lit(template), F.lit("{domain}"), F.col("domain")).alias("url"), F.concat("domain", F.lit(".png")).alias("filename"))


def logo_missing(companies: DataFrame, pages: DataFrame) -> DataFrame:
    return companies.filter("trim(wba_id) <> ''").join(domain_vote(pages), "wba_id", "left_anti").select("wba_id")


def homepage_pick(pages: DataFrame) -> DataFrame:
    """wba_id, name, homepage of the entities that have a name: their last one, and the last homepage row's URL, else https:// and the most frequent domain."""
    url, name = U.blank_to_null(F.col("url")), U.blank_to_null(F.col("company_name"))
    home = F.when((F.col("type") == "homepage") & url.isNotNull(), F.col("rec_id"))
    rows = pages.select(U.blank_to_null(F.col("wba_id")).alias("wba_id"), url.alias("url"), name.alias("name"), home.alias("home"), "rec_id").filter("wba_id is not null")
    known = rows.groupBy("wba_id").agg(F.max_by("name", F.when(F.col("name").isNotNull(), F.col("rec_id"))).alias("name"), F.max_by("url", "home").alias("_url")).filter("name is not null")
    votes = domain_vote(pages.withColumn("type", F.lit("")))
    return known.join(votes, "wba_id", "left").select("wba_id", "name", F.coalesce("_url", F.concat(F.lit("https://"), "domain")).alias("homepage"))


def ids_todo(pages: DataFrame, force: bool = False) -> DataFrame:
    """rec_id, link_id for pages without an id."""
    rows = pages if force or "link_id" not in pages.columns else pages.filter(F.coalesce(F.trim("link_id"), F.lit("")) == "")
    return rows.select("rec_id", U.link_id(F.col("wba_id"), F.col("url")).alias("link_id"))
