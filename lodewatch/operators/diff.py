"""Change detection between visits: new links, detections, alerts and the pages' updates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions import url as U

# Fixed values.
QUIET_TYPES = ("news",)
HIGH_TYPES = ("reports_hub", "sustainability_page")


# Most characters of a link list or history, and of an anchor text in a history line.
LONGEST_FIELD, LONGEST_TITLE = 90_000, 70


def _key(links: DataFrame, column) -> Column:
    """A link's key: the column ``key`` where the table has one, else made of its URL."""
    return F.col("key") if "key" in links.columns else column(F.col("document_url"))


def _compared(links: DataFrame, seen: DataFrame, shown: bool = True) -> DataFrame:
    """rec_id, key, now, old and, if asked for, shown (document_url, title; the least): what a page shows and what it had, both sides in one shuffle.

    Links without a key are left out; repeated ones are one. A page that holds many of the links is spread by key.
    """
    now = links.select("rec_id", _key(links, U.url_key).alias("key"), *([F.struct("document_url", U.strip(F.coalesce("title", F.lit(""))).alias("title")).alias("shown")] if shown else []), F.lit(True).alias("is_now"))
    old = seen.select("rec_id", _key(seen, U.canon_seen).alias("key"), *([F.lit(None).cast(dict(now.dtypes)["shown"]).alias("shown")] if shown else []), F.lit(False).alias("is_now"))
    both = now.unionByName(old).filter("key is not null")
    return both.groupBy("rec_id", "key").agg(F.bool_or("is_now").alias("now"), F.bool_or(~F.col("is_now")).alias("old"), *([F.min("shown").alias("shown")] if shown else []))


def _judged() -> Column:
    """Whether a page's changes count: it was visited before, so has a hash, and is of no quiet type."""
    return (F.coalesce("content_hash", F.lit("")) != "") & ~F.lower(F.trim(F.coalesce("type", F.lit("")))).isin(*QUIET_TYPES)


def _new(pages: DataFrame, links: DataFrame, seen: DataFrame, shown: bool = True) -> DataFrame:
    """The new links of pages that count, with the pages' columns."""
    return _compared(links, seen, shown).filter("now and not old").select("rec_id", "key", *(["shown.*"] if shown else [])).join(pages.filter(_judged()), "rec_id")


def _is_high(pdf: Column) -> Column:
    return pdf | F.coalesce(F.col("type").isin(*HIGH_TYPES), F.lit(False))


def _cut(text: Column, longest: int | None) -> Column:
    return text if longest is None else F.left(text, F.lit(longest))


def _line(entries: Column, run_date: dt.date, history: Column, longest: int | None = LONGEST_FIELD) -> Column:
    """The run's history line before the lines of earlier runs."""
    text = lambda e: F.concat(e["key"], F.when(e["title"] != "", F.concat(F.lit("  ["), F.left(e["title"], F.lit(LONGEST_TITLE)), F.lit("]"))).otherwise(""))
    line = F.concat(F.lit(f"{run_date.isoformat()}: "), F.array_join(F.transform(entries, text), " ; "))
    old = U.strip(F.coalesce(history, F.lit("")))
    return _cut(F.concat(line, F.when(old != "", F.concat(F.lit("\n"), old)).otherwise("")), longest)


def content_hash(pages: DataFrame, links: DataFrame) -> DataFrame:
    """rec_id, content_hash: md5 of a visited page's sorted distinct keys, one a line; a page without links has that of ''."""
    keyed = links.select("rec_id", U.url_key(F.col("document_url")).alias("key")).filter("key is not null").distinct()
    some = keyed.groupBy("rec_id").agg(F.array_join(F.array_sort(F.collect_list("key")), "\n").alias("text"))
    return pages.select("rec_id").join(some, "rec_id", "left").select("rec_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("content_hash"))


def change_detect(pages: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame:
    """rec_id, key: links that a page shows and had not, for pages with a baseline that are not of a quiet type.

    ``pages`` are the visited pages (rec_id, type, content_hash); ``links`` what they show (rec_id, document_url, title);
    ``seen`` what they had (rec_id, document_url; URLs or bare keys). A page without a content hash is on its first
    visit: its links become the baseline. One that had no link has a hash, so all its links are new. Null or empty
    hashes and types count as none; tables may be empty. Both may bring ``key``, the URLs' keys, which are made otherwise.
    """
    return _new(pages, links, seen, shown=False).select("rec_id", "key")


def detections(pages: DataFrame, links: DataFrame, seen: DataFrame, run_date: dt.date) -> DataFrame:
    """One row a new link: ids, company, page, document and its title, whether its key ends in .pdf, and the run's date."""
    pages = pages.withColumns({"_owner": U.owner(F.col("wba_id")), "_page_key": U.url_key_total(F.col("url"))})
    # A new link's key is never null, so it is the whole key too.
    return _new(pages, links, seen).select(
        F.lit(run_date).alias("detected"), "wba_id", "company_name", "document_url", "title", F.col("url").alias("found_on"), F.col("type").alias("page_type"), F.col("key").endswith(".pdf").alias("is_pdf"), F.lit("new").alias("status"),
        U.owned_id(F.col("_owner"), F.col("_page_key"), 8).alias("source_link_id"), U.owned_id(F.col("_owner"), U.detection_text(F.col("_page_key"), F.col("key")), 10).alias("detection_id"),
    )


def new_links_line(pages: DataFrame, links: DataFrame, seen: DataFrame, run_date: dt.date) -> DataFrame:
    """rec_id, new_links: the run's line, its keys in order with their anchor texts, before the page's history (new_links)."""
    entries = _new(pages, links, seen).groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("key", "title"))).alias("entries"), F.min("new_links").alias("history"))
    return entries.select("rec_id", _line(F.col("entries"), run_date, F.col("history")).alias("new_links"))


def alert_gate(pages: DataFrame, links: DataFrame, seen: DataFrame) -> DataFrame:
    """rec_id, n_new, high: pages with new links; high if one is a PDF or the page's type is exactly a high one."""
    new = _new(pages, links, seen).groupBy("rec_id").agg(F.count("*").alias("n_new"), F.bool_or(F.col("key").endswith(".pdf")).alias("pdf"), F.min("type").alias("type"))
    return new.select("rec_id", "n_new", _is_high(F.col("pdf")).alias("high"))


def page_updates(pages: DataFrame, links: DataFrame, seen: DataFrame, run_date: dt.date, longest: int | None = LONGEST_FIELD) -> DataFrame:
    """What a visit leaves on every page: rec_id, content_hash, seen_links, new_links, last_change, alert_status.

    Hash and links are always set. The other three are NULL, which leaves a page's fields as they are, unless new
    links count; the alert is set only by high ones. Ties of a key's URLs go to the least. Lists and histories are cut
    at ``longest`` signs, with None not at all.
    """
    shown = _compared(links, seen).filter("now").groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("key", F.col("shown.title").alias("title"), "old", F.col("shown.document_url").alias("url")))).alias("all"))
    rows = pages.join(shown, "rec_id", "left")
    every = F.coalesce("all", F.array().cast(dict(shown.dtypes)["all"]))
    rows = rows.withColumns({"_all": every, "_new": F.filter(every, lambda e: ~e["old"])})
    changed = _judged() & (F.size("_new") > 0)
    high = changed & _is_high(F.exists("_new", lambda e: e["key"].endswith(".pdf")))
    joined = lambda field: F.array_join(F.transform("_all", lambda e: e[field]), "\n")
    return rows.select(
        "rec_id", F.md5(joined("key").cast("binary")).alias("content_hash"), _cut(joined("url"), longest).alias("seen_links"),
        F.when(changed, _line(F.col("_new"), run_date, F.col("new_links"), longest)).alias("new_links"), F.when(changed, F.lit(run_date)).alias("last_change"), F.when(high, "new").alias("alert_status"),
    )


def fetch_status(http_status: Column, redirected: Column) -> tuple[Column, Column]:
    """(status, http_status as text): no answer is an error, 400 and above dead."""
    status = F.when(http_status.isNull(), "error").when(http_status >= 400, "dead").when(redirected, "redirected").otherwise("ok")
    return status, F.coalesce(http_status.cast("string"), F.lit(""))


def browser_status(http_status: Column, asked: Column, final: Column) -> tuple[Column, Column]:
    """The same for a page that a browser opened: no final URL is an error, another key than asked for a redirect."""
    moved = ~U.url_key(final).eqNullSafe(U.url_key(asked))
    status = F.when(F.coalesce(http_status, F.lit(0)) >= 400, "dead").when(final.isNull(), "error").when(moved, "redirected").otherwise("ok")
    return status, F.coalesce(http_status.cast("string"), F.lit(""))


def spa_handoff(pages: DataFrame, *, types: tuple[str, ...] = ("sustainability_page", "reports_hub", "sustainability_report", "policies", "investor_relations"), floor: int = 3) -> DataFrame:
    """rec_id, needs_browser for pages (rec_id, type, n_hard, spa, bait) whose documents a static fetch misses; no count is 0."""
    kind = F.lower(F.trim(F.coalesce("type", F.lit(""))))
    return pages.filter((F.coalesce("n_hard", F.lit(0)) < floor) & kind.isin(*types) & (F.col("spa") | F.col("bait"))).select("rec_id", F.lit(True).alias("needs_browser"))


def run_summary(log: DataFrame, queue: DataFrame, *, slow: float = 30.0) -> DataFrame:
    """One row: fetches by status, pages changed, alerted, promoted to the browser and slow, and how many of ``queue`` are left.

    ``log`` has http_status, redirected, changed, high, needs_browser, seconds; a null flag is false. Failed ones are
    those without an answer and dead ones together.
    """
    status, _ = fetch_status(F.col("http_status"), F.col("redirected"))
    n = lambda *s: F.count_if(F.col("s").isin(*s))
    done = log.withColumn("s", status).agg(
        F.count("*").alias("fetched"), n("error", "dead").alias("failed"), n("dead").alias("dead"), n("redirected").alias("redirected"), n("ok").alias("ok"),
        F.count_if("changed").alias("changed"), F.count_if("high").alias("alerted"), F.count_if("needs_browser").alias("promoted"), F.count_if(F.col("seconds") > slow).alias("slow"),
    )
    whole = queue.agg(F.count("*").alias("_queued"))
    return done.crossJoin(F.broadcast(whole)).withColumn("left", F.greatest(F.col("_queued") - F.col("fetched"), F.lit(0))).drop("_queued")
