"""URL and text functions against the standard library and hand-written cases."""

import datetime as dt
import hashlib
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodewatch.functions import text as X
from lodewatch.functions import url as U

URLS = [
    "https://User:pw@WWW.Example.com:8443/A/b/?b=2&a=1&utm_source=x&ref=y&reference=z#frag", "HTTP://www.www.example.org//x//", "https://ex.org/a]b", "https://[a-z0-9]+/x",
    "mailto:a@b.c", "ftp://ex.org/x", "", "   ", "https://ex.org/?q=&r=1&r=0", "https://ex.org/p?x=%zz&y=%E9&z=a+b%20c", "https://ex.org/~u/*?k=~*", "https://ex.org?a=1", " https://ex.org/t\tab ",
    "https://ex.org/a;b?c;d=1", "https://ex.org/%2Fq?A=B", "http://", "https://ex.org/UTM?UTM_x=1&gclid=2&mc_cid=3&_hsenc=4",
]


#: Their keys, by hand: no scheme, user, port, fragment, trailing slash or tracking parameter; parameters in order.
KEYS = [
    "example.com/a/b?a=1&b=2&reference=z",
    "www.example.org//x",
    "ex.org/a]b",
    None,
    None,
    None,
    None,
    None,
    "ex.org?r=0&r=1",
    "ex.org/p?x=%25zz&y=%ef%bf%bd&z=a+b+c",
    "ex.org/~u/*?k=~%2a",
    "ex.org?a=1",
    "ex.org/tab ",
    "ex.org/a;b?c%3bd=1",
    "ex.org/%2fq?a=b",
    "",
    "ex.org/utm",
]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_url_key(spark):
    assert column(spark, URLS, U.url_key) == KEYS
    total = column(spark, [*URLS, None], U.url_key_total)
    assert total == [k if k is not None else u.strip().lower() for k, u in zip(KEYS, URLS)] + [""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"\Ahttps?://(www\.)?[a-z]{1,5}\.(com|org)(/[A-Za-z0-9._-]{0,6}){0,3}(\?[a-z]{1,3}=[A-Za-z0-9]{0,3}(&[a-z]{1,3}=[a-z0-9]{0,2}){0,2})?(#x)?\Z"), min_size=1, max_size=40))
def test_url_key_of_any_plain_url(spark, urls):
    keys = column(spark, urls, U.url_key)
    assert column(spark, [f"https://{k}" for k in keys], U.url_key) == keys
    turned = ["?".join([u.partition("?")[0], "&".join(reversed(u.partition("?")[2].partition("#")[0].split("&")))]).upper().replace("HTTP", "http", 1).replace("httpS", "https", 1) for u in urls]
    assert column(spark, turned, U.url_key) == keys


def test_ids(spark):
    df = spark.createDataFrame([(" E1 ", "https://www.Ex.org/P/"), ("", "x Y"), (None, None)], "e string, u string")
    h = lambda s, n: hashlib.sha1(s.encode()).hexdigest()[:n]
    got = [tuple(r) for r in df.select(U.link_id(F.col("e"), F.col("u")), U.library_id(F.col("e"), F.col("u")), U.detection_id(F.col("e"), F.col("u"), F.col("u"))).collect()]
    assert got == [(f"{e}-{h(k, 8)}", f"{e}-{h(k, 10)}", f"{e}-{h(k + '|' + k, 10)}") for e, k in (("E1", "ex.org/p"), ("NA", "x y"), ("NA", ""))]


@pytest.mark.parametrize("base", ["https://ex.org/a/b/c.html?q=1#f", "http://ex.org", "https://ex.org/"])
def test_url_join(spark, base):
    refs = ["x.pdf", "/x", "//h.org/y", "?z=1", "#top", "../up", "../../../far", "./here/.", "https://o.org/p", "", "a/../b?c=d#e", ".."]
    assert column(spark, refs, lambda c: U.url_join(F.lit(base), c)) == [urljoin(base, r) for r in refs]


def test_document_predicates(spark):
    assert column(spark, ["https://x.org/A.PDF?x", "https://x.org/static-files/1", "https://x.org/a.pdf#p", "https://x.org/pdf", None], U.is_pdf_url) == [True, True, True, False, False]
    assert column(spark, ["https://x.org/2019/r-2024.pdf?y=2026", "x12015x", "2031 2010", "none", None], U.year_of) == ["2026", "2015", "2010", "", ""]
    assert column(spark, ["iso.org", "www.iso.org", "miso.org", "europa.eu", None], U.is_framework_host) == [True, True, False, True, False]
    assert column(spark, ["https://a.b.example.co.uk/x", "https://example.com", "http://10.0.0.1/x", "https://localhost/x"], U.registrable_domain) == ["example.co.uk", "example.com", "10.0.0.1", "localhost"]
    assert column(spark, ["https://x.org/a%20b.pdf", "https://x.org/a+b", "https://x.org/", "https://x.org/r.doc"], lambda c: U.filename_for(c, F.lit("L1"))) == ["a b.pdf", "L1.pdf", "L1.pdf", "r.doc.pdf"]
    assert column(spark, ["ex.org/a", " https://ex.org ", "", None], U.fetchable) == ["https://ex.org/a", "https://ex.org", "", ""]


def test_page_text(spark):
    html = ["<!-- a --><P>One<script>x<b></script> two</P>\n three &amp; four", None, "<html><div id='__next'></div>", "<html>" + "<i></i>" * 2000 + "short"]
    assert column(spark, html[:2], X.visible_text) == ["One two three &amp; four", ""]
    assert column(spark, html, X.looks_like_spa) == [False, False, True, True]
    tags = ['<html lang="zh-CN">', "<HTML class=x lang=en_US>", '<html lang="x">', "<html>", '<html data-lang="fr" lang="de">', None]
    assert column(spark, tags, X.declared_language) == ["zh", "English", None, None, "German", None]
    assert column(spark, ["zh-tw", "pt-BR", "qq", "", None], X.lang_name) == ["Chinese (Traditional)", "Portuguese", "qq", None, None]
    assert column(spark, ["https://x.org/diversity-report", "https://x.org/annual", "https://x.org/ir/", "https://x.org/zzz", "https://x.org/tax"], lambda c: X.page_type(c, F.lit(""))) == ["sustainability_page", "reports_hub", "investor_relations", "other", "policies"]


def test_due_days(spark):
    freqs = ["daily", "mon_wed_fri", "mon_fri", "weekly", "monthly", "quarterly", "", None]
    for k in range(8):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=k)  # a Monday that is also a first of the month
        monday, first = day.weekday() == 0, day.day == 1
        want = [True, day.weekday() in (0, 2, 4), day.weekday() in (0, 4), monday, first, first, monday, monday]
        assert column(spark, freqs, lambda c, day=day: X.is_due(c, F.lit(day))) == want
    assert all(column(spark, freqs, lambda c: X.is_due(c, F.lit(dt.date(2024, 1, 2)), force=True)))


def test_languages_of_pages_and_texts(spark):
    texts = ["The report of the group is for all of the people", "Der Bericht ist für die Gruppe und nicht für das Haus", "Le rapport est pour les groupes et dans une maison", "El informe para los grupos y las casas del lugar", "the", None, "1234 5678", "xxxxx " * 20]
    assert column(spark, texts, X.detect_language) == ["English", "German", "French", "Spanish", None, None, None, None]
    html = ["<p>" + texts[1], "<html lang=fr><p>" + texts[1], "<script>" + texts[0] + "</script>", None]
    assert column(spark, html, X.page_language) == ["German", "French", None, None]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) > 300")
    names = F.element_at(X.literal_map({"en": "English", "de": "German", "fr": "French", "es": "Spanish"}), F.col("lang"))
    right, n = docs.select(F.count_if(X.detect_language(F.col("text")) == names), F.count("*")).first()
    assert n > 50 and right > 0.9 * n
