"""Links of pages: anchors by an Arrow UDF (only the tokenizer), everything after it as Column expressions."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.functions import url as U

# Fixed values.
ASSET = r"(?iu)\.(png|jpe?g|gif|svg|webp|ico|css|js|woff2?|ttf|mp4)([?#]|$)"
RAW_URL = r"""https?://[^\s"'<>\\){}\[\]]+|(?<=["'])/[^\s"'<>\\){}\[\]]+"""
PDF_SEGMENT = r"(?iu)/pdfs?/"
JUNK = r"(?iu)login|signin|sign-in|account|cart|basket|checkout|privacy|cookie|terms|legal-notice|sitemap|search|subscribe|newsletter|/wp-|\.(jpg|png|gif|svg|css|js)$"
ANCHOR_TEXT, RAW_SCAN = 80, 500_000


class _Anchors(HTMLParser):
    """Collects (href, text) of every anchor that has an href, in document order; nested text pieces are joined by a space."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list[list] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            href = dict(reversed(attrs)).get("href")
            item = [href, []]
            self.open.append(item)
            if href is not None:
                self.found.append(item)

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.open.pop()

    def handle_data(self, data):
        if data.strip():
            for item in self.open:
                item[1].append(data.strip())


def read_anchors(html: str | None) -> list[dict]:
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    return [{"pos": i, "href": href.strip(), "text": " ".join(texts)[:ANCHOR_TEXT]} for i, (href, texts) in enumerate(parser.found)]


def anchors(html: str) -> Column:
    """The anchors of an HTML column, by Arrow batches."""

    def read(pages: pd.Series) -> pd.Series:
        return pages.map(read_anchors)

    return F.pandas_udf(read, "array<struct<pos:int,href:string,text:string>>")(html)


def page_anchors(pages: DataFrame) -> DataFrame:
    """page_id, base, pos, text, link: every anchor of (page_id, url, html), resolved; pseudo links are left out."""
    rows = pages.select("page_id", F.col("url").alias("base"), F.inline(anchors("html")))
    return rows.filter(~F.col("href").rlike("^(#|mailto:|tel:|javascript:)")).select("page_id", "base", "pos", "text", U.url_join(F.col("base"), F.col("href")).alias("link"))


def _own_or_document(link: Column, base: Column, lower_path: Column) -> Column:
    """The policy across domains: same domain, a document id, or a document that no framework publisher hosts."""
    hard = lower_path.endswith(".pdf") | U.is_document_endpoint(lower_path)
    return (U.registrable_domain(link) == U.registrable_domain(base)) | U.has_document_id(link) | (hard & ~U.is_framework_host(U.host(link)))


def _first_of_key(rows: DataFrame) -> DataFrame:
    first = Window.partitionBy("page_id", "key").orderBy("sweep", "pos")
    return rows.filter("key is not null").withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def _anchor_links(pages: DataFrame) -> DataFrame:
    p = F.lower(U.path(F.col("link")))
    document = p.endswith(".pdf") | p.rlike(U.REPORTISH_PATH) | U.has_document_id(F.col("link")) | U.is_document_endpoint(p)
    rows = page_anchors(pages).filter(document).filter(_own_or_document(F.col("link"), F.col("base"), p))
    return rows.select("page_id", F.lit(0).alias("sweep"), "pos", U.url_key(F.col("link")).alias("key"), "link", "text")


def _raw_links(pages: DataFrame) -> DataFrame:
    raw = F.replace(F.substring("html", 1, RAW_SCAN), F.lit("\\/"), F.lit("/"))
    rows = pages.select("page_id", F.col("url").alias("base"), F.posexplode(F.regexp_extract_all(raw, F.lit(RAW_URL), F.lit(0))).alias("pos", "href"))
    rows = rows.select("page_id", "base", "pos", U.url_join(F.col("base"), F.col("href")).alias("link"))
    p = F.lower(U.path(F.col("link")))
    hard = p.endswith(".pdf") | p.rlike(PDF_SEGMENT) | U.has_document_id(F.col("link")) | U.is_document_endpoint(p)
    rows = rows.filter(~p.rlike(ASSET)).filter(hard).filter(_own_or_document(F.col("link"), F.col("base"), p))
    return rows.select("page_id", F.lit(1).alias("sweep"), "pos", U.url_key(F.col("link")).alias("key"), "link", F.lit("").alias("text"))


def doc_links_anchor(pages: DataFrame) -> DataFrame:
    """page_id, key, link, text: document links among anchors, the first of each key."""
    return _first_of_key(_anchor_links(pages)).drop("sweep", "pos")


def doc_links_raw(pages: DataFrame) -> DataFrame:
    """page_id, key, link, text (''): hard document URLs anywhere in the page's source."""
    return _first_of_key(_raw_links(pages)).drop("sweep", "pos")


def doc_links(pages: DataFrame) -> DataFrame:
    """Both passes; an anchor's entry stands before the sweep's."""
    return _first_of_key(_anchor_links(pages).unionByName(_raw_links(pages))).drop("sweep", "pos")


def links_on(pages: DataFrame) -> DataFrame:
    """page_id, pos, link (clean), text: same-domain links that are not junk, in document order, repeats kept."""
    rows = page_anchors(pages).filter(F.col("link").rlike("^https?://") & ~F.col("link").rlike(JUNK))
    rows = rows.filter(U.registrable_domain(F.col("link")) == U.registrable_domain(F.col("base")))
    return rows.select("page_id", "pos", U.url_clean(F.col("link")).alias("link"), "text").filter("link is not null")


def page_has_doc(pages: DataFrame) -> DataFrame:
    """page_id, has_doc: whether a same-domain link of the page is a PDF or has a report-like path."""
    p = F.lower(U.path(F.col("link")))
    found = links_on(pages).groupBy("page_id").agg(F.bool_or(p.endswith(".pdf") | p.rlike(U.DISCOVERY_PATH)).alias("has_doc"))
    return pages.select("page_id").join(found, "page_id", "left").select("page_id", F.coalesce("has_doc", F.lit(False)).alias("has_doc"))


def n_hard_docs(links: DataFrame, page: str = "rec_id", link: str = "document_url") -> DataFrame:
    """page, n_hard: links that end in .pdf before the query or carry a document id."""
    hard = F.lower(F.substring_index(link, "?", 1)).endswith(".pdf") | U.has_document_id(F.col(link))
    return links.groupBy(page).agg(F.count_if(hard).alias("n_hard"))
