"""Operators on hand-written tables: the cases that the registered tables do not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodewatch.functions.vocab import rows as vocabulary_rows
from lodewatch.functions.vocab import vocabulary
from lodewatch.operators import classify, coverage, diff, discover, files, harvest, links, schedule
from lodewatch.fixtures import Tables
from lodewatch.sources import tables
from lodewatch.streaming import changes

DAY = dt.date(2024, 2, 1)


def test_anchors_and_domain_policy(spark):
    html = """<A HREF=/report.html>Our <b>big</b> report</A><a href="https://cdn.other.net/f.pdf?a=1&amp;b=2">x</a><a href="https://www.iso.org/s.pdf">s</a>
    <a href="https://iso.org/docs?documentId=7">d</a><a href="https://other.net/static-files/abc">e</a><a href="mailto:a@b.c">m</a><a href="https://[bad/report">bad</a>
    <a href="/report.html#again">twice</a><a href="https://other.net/annual">page</a><script>{"u":"https:\\/\\/cdn.x.io\\/raw.pdf","p":"/pdfs/one","i":"/a.pdf.png"}</script>"""
    pages = spark.createDataFrame([(1, "https://www.ex.org/hub/", html), (2, "https://ex.org", None)], "page_id long, url string, html string")
    got = {r.key: (r.link, r.text) for r in links.doc_links(pages).collect()}
    assert got["ex.org/report.html"] == ("https://www.ex.org/report.html", "Our big report")
    assert {"cdn.other.net/f.pdf?a=1&b=2", "iso.org/docs?documentid=7", "other.net/static-files/abc", "cdn.x.io/raw.pdf", "ex.org/pdfs/one"} <= set(got)
    assert "iso.org/s.pdf" not in got and "other.net/annual" not in got and not any("png" in k for k in got)


def _links(spark, rows):
    return spark.createDataFrame(rows, "rec_id string, wba_id string, type string, page_url string, document_url string")


def test_change_detection_states(spark):
    u, b = "https://Ex.org/a.PDF", "https://ex.org/b"
    pages = [("first", "policies", None, None), ("same", "policies", "h", None), ("more", "policies", "h", "2024-01-01: ex.org/0\n"), ("news", " News ", "h", None), ("hub", "reports_hub", "h", ""), ("bare", None, "d41d8cd98f00b204e9800998ecf8427e", None), ("gone", "policies", "h", None), ("blank", "policies", " " * 0, None)]
    pages = spark.createDataFrame([(r, "E", "Co", "https://p", *x) for r, *x in pages], "rec_id string, wba_id string, company_name string, url string, type string, content_hash string, new_links string")
    links = spark.createDataFrame([("first", u, "A"), ("same", u, None), ("more", u, "A"), ("more", b, " B " + "x" * 90), ("more", b + "/", "A"), ("news", u, ""), ("hub", b, ""), ("bare", u, "A"), ("blank", u, "A"), ("same", None, "no link")], "rec_id string, document_url string, title string")
    seen = spark.createDataFrame([("same", "ex.org/a.pdf"), ("more", "https://www.ex.org/a.pdf"), ("more", "ex.org/gone"), ("news", "ex.org/z"), ("hub", "ex.org/z"), ("gone", "ex.org/z")], "rec_id string, document_url string")
    sides = (pages, links, seen)
    assert {(r.rec_id, r.key) for r in diff.change_detect(*sides).collect()} == {("more", "ex.org/b"), ("hub", "ex.org/b"), ("bare", "ex.org/a.pdf")}
    assert {(r.rec_id, r.high) for r in diff.alert_gate(*sides).collect()} == {("more", False), ("hub", True), ("bare", True)}
    assert diff.change_detect(pages, links, links.select("rec_id", "document_url")).count() == 0 and diff.change_detect(pages, links.limit(0), seen).count() == 0
    got = {r.rec_id: r for r in diff.page_updates(*sides, DAY).collect()}
    assert len(got) == 8 and got["gone"].content_hash == "d41d8cd98f00b204e9800998ecf8427e" and got["gone"].seen_links == ""
    line = f"2024-02-01: ex.org/b  [B {'x' * 68}]"
    assert (got["more"].new_links, got["more"].last_change, got["more"].alert_status, got["more"].seen_links) == (line + "\n2024-01-01: ex.org/0", DAY, None, f"{u}\n{b}")
    assert got["hub"].alert_status == "new" and got["bare"].new_links == "2024-02-01: ex.org/a.pdf  [A]" and got["first"].new_links is None and got["news"].last_change is None
    assert {r.rec_id: r.new_links for r in diff.new_links_line(*sides, DAY).collect()} == {k: got[k].new_links for k in ("more", "hub", "bare")}
    assert {(r.title, r.company_name) for r in diff.detections(*sides, DAY).collect()} == {("B " + "x" * 90, "Co"), ("", "Co"), ("A", "Co")}


@pytest.mark.parametrize(("years", "want"), [([2020], "single (2020)"), ([2019, 2020, 2021], "annual (next ~2022)"), ([2016, 2018, 2020], "biennial (next ~2022)"), ([2010, 2013, 2016, 2017], "~every 3y (next ~2020)"), ([2017, 2018, 2020], "irregular (last 2020)")])
def test_cadence(spark, years, want):
    rows = [("E", "ESG Report", None, float(y), True, False) for y in years] * 2
    library = spark.createDataFrame(rows, "wba_id string, source_type_check string, source_type string, year double, has_file boolean, discard boolean")
    assert [r.sust_cadence for r in coverage.sust_cadence(library).collect()] == [want]


def test_coverage_of_a_walled_and_an_unknown_company(spark):
    companies = spark.createDataFrame([("c1", " A "), ("c2", "B"), ("c3", "")], "rec_id string, wba_id string")
    pages = spark.createDataFrame([("A", "reports_hub", True, False, "error")], "wba_id string, type string, monitor boolean, needs_browser boolean, status string")
    library = spark.createDataFrame([], "wba_id string, source_type_check string, source_type string, year int, has_file boolean, discard boolean")
    got = {r.wba_id: r for r in coverage.coverage_full(companies, pages, library, year_min=2020).collect()}
    assert got["A"].coverage_flags == "no_sustainability_page; no_docs; browser_dependent; no_sust_report_2020+; no_annual_report_2020+"
    assert got["B"].coverage_flags.startswith("no_urls; no_reports_hub; ") and got["B"].sust_cadence == "none" and set(got) == {"A", "B"}


def test_classifier_edges(spark):
    terms = {"First": ["green report", "iso"], "Second": ["green", "report", "iso"], "Third": ["half-year"]}
    own = spark.createDataFrame(vocabulary_rows(terms), "type_ord int, type string, term string, n_words int")
    urls = ["https://x/green_report.pdf", "https://x/vision", "https://x/iso", "https://x/half-year", "https://x", None, "https://x/report/x/green"]
    df = spark.createDataFrame(list(enumerate(urls)), "doc_key int, document_url string")
    got = {r.doc_key: (r.source_type, r.match_confidence) for r in classify.classify_library(df, own).collect()}
    assert [got[i] for i in range(7)] == [("First", "high"), ("", "unresolved"), ("First", "low"), ("", "unresolved"), ("", "unresolved"), ("", "unresolved"), ("Second", "low")]


@pytest.mark.parametrize("batch", [0, 1, 3, 4, 8, 20])
@pytest.mark.parametrize("pools", [(10, 10), (1, 9), (9, 1), (0, 3)])
def test_queue(spark, batch, pools):
    rows = [(f"p{i:02}", "ok", None if i % 4 == 0 else f"2024-01-{1 + i % 5:02}") for i in range(pools[0])] + [(f"r{i:02}", ("dead", "error")[i % 2], f"2024-01-{1 + i % 5:02}") for i in range(pools[1])]
    df = spark.createDataFrame(rows, "rec_id string, status string, last_checked string")
    by = lambda pool: [r for r, _, _ in sorted((x for x in rows if x[0][0] == pool), key=lambda x: (x[2] or "", x[0]))]
    p, r = by("p"), by("r")
    cap = int(batch * 0.25)
    want = p + r if batch <= 0 else (p[: batch - cap] + r[:cap] + p[batch - cap :] + r[cap:])[:batch]
    assert [x.rec_id for x in schedule.order_targets(df, batch).orderBy("turn").collect()] == want


def test_accept_is_in_order(spark):
    rows = [("E", 1, "https://e.org/annual", "", True), ("E", 2, "https://e.org/annual/", "", True), ("E", 3, "https://e.org/report", "", False), ("E", 4, "https://e.org/results", "", True), ("E", 5, "https://e.org/zzz", "", False), ("E", 6, "https://e.org/yyy", "", True), ("E", 7, "https://e.org/known", "", True)]
    candidates = spark.createDataFrame(rows, "wba_id string, rank int, link string, text string, has_doc boolean")
    known = spark.createDataFrame([("E", "e.org/known")], "wba_id string, key string")
    got = discover.crawl_accept(candidates, known).orderBy("place").collect()
    assert [(r.link, r.type) for r in got] == [("https://e.org/annual", "reports_hub"), ("https://e.org/report", "reports_hub"), ("https://e.org/yyy", "other")]


def test_harvest_first_wins_and_guard(spark):
    doc = "https://x.org/annual-2020.pdf"
    rows = [(f"r{i}", f"E{i}", "reports_hub", f"https://p{i}", doc) for i in range(5)] + [("r9", "E0", "reports_hub", "https://late", "https://www.x.org/annual-2020.pdf"), ("r1", "E1", "news", "https://n", "https://x.org/n.pdf"), ("r2", "E2", "policies", "https://p2", "x.org/own.pdf"), ("r3", "E3", "policies", "https://p3", " ")]
    built = harvest.harvest_build(harvest.harvest_explode(_links(spark, rows))).cache()
    assert {(r.wba_id, r.document_url, r.found_on) for r in built.collect()} == {(f"E{i}", doc, f"https://p{i}") for i in range(5)} | {("E2", "https://x.org/own.pdf", "https://p2")}
    assert [r.wba_id for r in harvest.shared_docs_guard(built, 5).collect()] == ["E2"]
    assert harvest.shared_docs_guard(built, 6).count() == 6
    pages = spark.createDataFrame([("p", "E", "policies", "https://x.org/self.pdf", "")], "rec_id string, wba_id string, type string, url string, is_pdf string")
    assert harvest.harvest_explode(_links(spark, []), pages).count() == 1
    existing = built.select("library_id", "document_url", F.lit(dt.date(2020, 1, 1)).alias("first_seen"))
    assert harvest.harvest_incremental(built, existing, DAY).count() == 0
    assert {r.op for r in harvest.harvest_incremental(built, existing, DAY, full=True).collect()} == {"update"}


def test_plans_are_idempotent(spark):
    now = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "id string, n int, t string")
    new = spark.createDataFrame([("a", 1, None), ("b", 3, None), ("c", 4, "y")], "id string, n int, t string")
    done = tables.upsert(now, new, "id").cache()
    assert {tuple(r) for r in done.collect()} == {("a", 1, None), ("b", 3, None), ("c", 4, "y")}
    assert tables.update_plan(done, new, "id", ["n", "t"]).count() == 0


def test_csv_with_mark_and_line_ends(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('﻿name,note\n"a","one\ntwo ""q"""\n'.encode())
    assert [tuple(r) for r in tables.scan_csv(spark, str(tmp_path / "x.csv")).select("name", "note").collect()] == [("a", 'one\ntwo "q"')]


def test_stream_replaces_state(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, at(1), ["a"]), (1, at(2), ["a", "b"]), (2, at(2), None), (1, at(3), ["b"]), (1, at(4), ["a", "b"]), (2, at(4), ["z"])]
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, changes.VISITS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(changes.VISITS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    job = changes.stream_changes(stream).writeStream.format("memory").queryName("seen_changes").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    job.awaitTermination()
    want = {(1, at(2), "b"), (1, at(4), "a"), (2, at(4), "z")}
    assert {tuple(r) for r in spark.table("seen_changes").collect()} == want
    assert {tuple(r) for r in changes.batch_changes(spark.createDataFrame(rows, changes.VISITS)).collect()} == want


def test_plans_stay_native(spark):
    df = spark.createDataFrame([(1, "https://x/iso")], "doc_key int, document_url string")
    plan = classify.classify_library(df, vocabulary(spark))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan and "Python" not in plan


def test_cover_states(spark):
    rows = [(None, None, None, None), (b"<html>", None, None, None), (b"%PDF-1 body", None, True, "t"), (b"%PDF-1 %%EOF", 99, True, "t"), (b"%PDF-1 %%EOF", None, False, None), (b"%PDF-1 %%EOF", None, True, " "), (b"%PDF-1 %%EOF", 5, True, "t")]
    df = spark.createDataFrame([(i, bytearray(b) if b else None, n, p, t) for i, (b, n, p, t) in enumerate(rows)], "i int, b binary, n long, p boolean, t string")
    got = [r[0] for r in df.orderBy("i").select(files.cover_outcome(F.col("b"), F.col("n"), F.col("p"), F.col("t"))).collect()]
    assert got == ["download_fail", "not_pdf", "truncated", "truncated", "parse_fail", "no_text", "ok"]


def test_coverage_scans_each_table_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = coverage.coverage_full(t.companies, t.monitored_links, t.report_library, year_min=2020)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 3 and "Exchange SinglePartition" not in plan


def test_all_pages_are_ordered_in_many_tasks(spark):
    df = spark.createDataFrame([(f"r{i:03}", ("dead", "ok")[i % 3 > 0], None if i % 4 else "2024-01-01") for i in range(200)], "rec_id string, status string, last_checked string")
    for seed in (None, 7):
        turns = [(x.turn, x.pool) for x in schedule.order_targets(df, 0, seed=seed).collect()]
        assert sorted(t for t, _ in turns) == list(range(1, 201)) and {p for t, p in turns if t <= 133} == {"productive"}
    assert [x.rec_id for x in schedule.order_targets(df, 0, seed=1).orderBy("turn").collect()] != [x.rec_id for x in schedule.order_targets(df, 0, seed=2).orderBy("turn").collect()]
    assert schedule.queue_remaining(df, 0).first()[0] == 0 and schedule.queue_remaining(df, 300).first()[0] == 0 and schedule.queue_remaining(df, 150).first()[0] == 50
