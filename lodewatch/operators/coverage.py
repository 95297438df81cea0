"""Coverage of each entity: rollups, gap flags, breakdowns and publishing cadence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.functions.text import effective_type
from lodewatch.functions.url import blank_to_null

# Families of types as the flags name them.
SUST = ("Sustainability Report", "ESG Report", "CSR Report", "Integrated Report", "Impact Report")
ANNUAL = ("Annual Report", "Integrated Report", "10K Form")
IMPORTANT = ("Code of Conduct", "Human Rights Policy", "Policy Documents")
REPORTS = (*SUST, *ANNUAL, "Climate Report", "Environmental Reports", "Social Reports", "Interim Reports", "Financial Statement", "Registration Document", "CDP Report", "GRI", "SASB Index", "Engagement Report")
STATS = ("urls_total", "urls_monitored", "docs_total", "docs_with_file", "docs_typed", "latest_report_year", "coverage_breakdown", "coverage_flags", "missing_types", "pages_breakdown", "docs_by_year", "sust_years", "sust_cadence", "sust_reports_total")


def _pages(pages: DataFrame) -> DataFrame:
    return pages.withColumn("wba_id", blank_to_null(F.col("wba_id"))).filter("wba_id is not null")


def live_docs(library: DataFrame) -> DataFrame:
    """wba_id, t (effective type), y (year within 2000 to 2039, else NULL), has_file: rows that count."""
    year = F.when(F.col("year").cast("int").between(2000, 2039), F.col("year").cast("int"))
    rows = library.withColumn("wba_id", blank_to_null(F.col("wba_id"))).filter("wba_id is not null").filter(~F.coalesce("discard", F.lit(False)))
    return rows.select("wba_id", effective_type(F.col("source_type_check"), F.col("source_type")).alias("t"), year.alias("y"), F.coalesce("has_file", F.lit(False)).alias("has_file"))


def coverage_urls(pages: DataFrame) -> DataFrame:
    """wba_id, urls_total, urls_monitored, browser_lane."""
    browser = F.coalesce("needs_browser", F.lit(False)) | F.coalesce(F.col("status").isin("dead", "error"), F.lit(False))
    return _pages(pages).groupBy("wba_id").agg(F.count("*").alias("urls_total"), F.count_if("monitor").alias("urls_monitored"), F.count_if(browser).alias("browser_lane"))


def coverage_docs(library: DataFrame) -> DataFrame:
    """wba_id, docs_total, docs_with_file, docs_typed, latest_report_year."""
    return live_docs(library).groupBy("wba_id").agg(F.count("*").alias("docs_total"), F.count_if("has_file").alias("docs_with_file"), F.count_if(~F.col("t").isin("", "UNKNOWN")).alias("docs_typed"), F.max(F.when(F.col("t").isin(*REPORTS), F.col("y"))).alias("latest_report_year"))


def coverage_years(library: DataFrame) -> DataFrame:
    """wba_id, year (NULL: undated), n."""
    return live_docs(library).groupBy("wba_id", F.col("y").alias("year")).agg(F.count("*").alias("n"))


def coverage_latest(library: DataFrame) -> DataFrame:
    """wba_id, type, n, latest for every effective type."""
    return live_docs(library).filter("t <> ''").groupBy("wba_id", F.col("t").alias("type")).agg(F.count("*").alias("n"), F.max("y").alias("latest"))


def page_types(pages: DataFrame) -> DataFrame:
    return _pages(pages).withColumn("type", blank_to_null(F.col("type"))).filter("type is not null").groupBy("wba_id", "type").agg(F.count("*").alias("n"))


def _lines(counts: DataFrame, name: str, text: Column, sep: str = "\n") -> DataFrame:
    """wba_id and its lines, by count downwards, then name."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "type", text.alias("line"))))
    return counts.groupBy("wba_id").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), sep).alias(name))


def coverage_breakdown(library: DataFrame) -> DataFrame:
    latest = F.when(F.col("latest").isNotNull(), F.concat(F.lit(" (latest "), F.col("latest").cast("string"), F.lit(")"))).otherwise("")
    return _lines(coverage_latest(library), "coverage_breakdown", F.concat("type", F.lit(": "), F.col("n").cast("string"), latest))


def pages_breakdown(pages: DataFrame) -> DataFrame:
    return _lines(page_types(pages), "pages_breakdown", F.concat("type", F.lit(": "), F.col("n").cast("string")))


def docs_by_year(library: DataFrame) -> DataFrame:
    """wba_id, docs_by_year: years downwards, undated last."""
    part = F.struct(F.coalesce(-F.col("year"), F.lit(0)).alias("o"), F.concat(F.coalesce(F.col("year").cast("string"), F.lit("undated")), F.lit(": "), F.col("n").cast("string")).alias("line"))
    return coverage_years(library).groupBy("wba_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["line"]), " | ").alias("docs_by_year"))


def sust_totals(library: DataFrame) -> DataFrame:
    """wba_id, sust_reports_total, sust_years."""
    rows = live_docs(library).filter(F.col("t").isin(*SUST))
    years = F.array_join(F.transform(F.array_sort(F.collect_set("y")), lambda y: y.cast("string")), "; ")
    return rows.groupBy("wba_id").agg(F.count("*").alias("sust_reports_total"), years.alias("sust_years"))


def sust_cadence(library: DataFrame) -> DataFrame:
    """wba_id, sust_cadence of every entity with a dated report of the family: its rhythm from the gaps between years."""
    years = live_docs(library).filter(F.col("t").isin(*SUST) & F.col("y").isNotNull()).select("wba_id", "y").distinct()
    gaps = years.withColumn("gap", F.col("y") - F.lag("y").over(Window.partitionBy("wba_id").orderBy("y")))
    by_gap = gaps.groupBy("wba_id", "gap").agg(F.count("gap").alias("n"), F.max("y").alias("last"))
    summed = by_gap.groupBy("wba_id").agg(F.max("last").alias("last"), F.sum("n").alias("gaps"), F.max(F.struct("n", "gap")).alias("modal"), F.min("gap").alias("least"), F.max("gap").alias("most"))
    next_ = lambda step: F.concat(F.lit("(next ~"), (F.col("last") + step).cast("string"), F.lit(")"))
    text = (
        F.when(F.col("gaps") == 0, F.concat(F.lit("single ("), F.col("last").cast("string"), F.lit(")")))
        .when((F.col("least") == 1) & (F.col("most") == 1), F.concat(F.lit("annual "), next_(F.lit(1))))
        .when((F.col("least") == 2) & (F.col("most") == 2), F.concat(F.lit("biennial "), next_(F.lit(2))))
        .when(F.col("modal.n") / F.col("gaps") >= 0.6, F.concat(F.lit("~every "), F.col("modal.gap").cast("string"), F.lit("y "), next_(F.col("modal.gap"))))
        .otherwise(F.concat(F.lit("irregular (last "), F.col("last").cast("string"), F.lit(")")))
    )
    return summed.select("wba_id", text.alias("sust_cadence"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for a row and hands it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda s, x: s + x["n"])


def _by(cells: Column, field: str, line: Callable[[Column, Column], Column], order: Callable[[Column, Column], Column], sep: str) -> Column:
    """A line for each value of ``field`` from that value's cells, in order."""
    groups = F.transform(F.array_distinct(F.transform(cells, lambda x: x[field])), lambda v: F.struct(v.alias("v"), F.filter(cells, lambda x: x[field].eqNullSafe(v)).alias("own")))
    lines = F.transform(groups, lambda g: F.struct(order(g["v"], g["own"]).alias("o"), line(g["v"], g["own"]).alias("line")))
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), sep)


def _cadence(years: Column) -> Column:
    """The rhythm of a sorted array of distinct years; NULL if it is empty."""

    def told(gaps: Column) -> Column:
        last = F.array_max(years)
        next_ = lambda step: F.concat(F.lit("(next ~"), (last + step).cast("string"), F.lit(")"))
        modal = F.array_max(F.transform(F.array_distinct(gaps), lambda g: F.struct(F.size(F.filter(gaps, lambda x: x == g)).alias("n"), g.alias("gap"))))
        every = lambda n: (F.array_min(gaps) == n) & (F.array_max(gaps) == n)
        return (
            F.when(F.size(years) == 0, F.lit(None).cast("string"))
            .when(F.size(years) == 1, F.concat(F.lit("single ("), last.cast("string"), F.lit(")")))
            .when(every(1), F.concat(F.lit("annual "), next_(F.lit(1))))
            .when(every(2), F.concat(F.lit("biennial "), next_(F.lit(2))))
            .when(modal["n"] / F.size(gaps) >= 0.6, F.concat(F.lit("~every "), modal["gap"].cast("string"), F.lit("y "), next_(modal["gap"])))
            .otherwise(F.concat(F.lit("irregular (last "), last.cast("string"), F.lit(")")))
        )

    gaps = F.when(F.size(years) < 2, F.array().cast("array<int>")).otherwise(F.transform(F.slice(years, 2, F.size(years)), lambda y, i: y - F.get(years, i)))
    return _let(gaps, told)


def entity_docs(library: DataFrame) -> DataFrame:
    """All of an entity's figures on documents, from one scan: its rows are counted by type and year first, which leaves few cells."""
    cells = live_docs(library).groupBy("wba_id", "t", "y").agg(F.count("*").alias("n"), F.count_if("has_file").alias("files"))
    t, y = F.col("t"), F.col("y")
    latest = lambda names: F.max(F.when(t.isin(*names), y))
    rows = cells.groupBy("wba_id").agg(
        F.sum("n").alias("docs_total"), F.sum("files").alias("docs_with_file"), F.sum(F.when(t.isin("", "UNKNOWN"), 0).otherwise(F.col("n"))).alias("docs_typed"),
        latest(REPORTS).alias("latest_report_year"), latest(SUST).alias("_sust"), latest(ANNUAL).alias("_annual"),
        F.bool_or(t.isin(*SUST)).alias("_has_sust"), F.bool_or(t.isin(*ANNUAL)).alias("_has_annual"), *(F.bool_or(t == x).alias(f"_has{i}") for i, x in enumerate(IMPORTANT)),
        F.collect_list(F.struct("t", "y", "n")).alias("cells"),
    )
    text = lambda x: x.cast("string")
    newest = lambda own: F.array_max(F.transform(own, lambda x: x["y"]))
    typed = lambda v, own: F.concat(v, F.lit(": "), text(_total(own)), F.coalesce(F.concat(F.lit(" (latest "), text(newest(own)), F.lit(")")), F.lit("")))
    dated = lambda v, own: F.concat(F.coalesce(text(v), F.lit("undated")), F.lit(": "), text(_total(own)))
    sust = F.filter("cells", lambda x: x["t"].isin(*SUST))
    years = F.array_sort(F.array_distinct(F.transform(F.filter(sust, lambda x: x["y"].isNotNull()), lambda x: x["y"])))
    return rows.withColumn("_years", years).select(
        *(c for c in rows.columns if c != "cells"),
        _by(F.filter("cells", lambda x: x["t"] != ""), "t", typed, lambda v, own: F.struct((-_total(own)).alias("n"), v.alias("v")), "\n").alias("coverage_breakdown"),
        _by(F.col("cells"), "y", dated, lambda v, own: F.coalesce(-v, F.lit(0)), " | ").alias("docs_by_year"),
        _total(sust).alias("sust_reports_total"), F.array_join(F.transform("_years", text), "; ").alias("sust_years"), _cadence(F.col("_years")).alias("sust_cadence"),
    )


def entity_pages(pages: DataFrame) -> DataFrame:
    """All of an entity's figures on pages, from one scan."""
    browser = F.coalesce("needs_browser", F.lit(False)) | F.coalesce(F.col("status").isin("dead", "error"), F.lit(False))
    cells = _pages(pages).groupBy("wba_id", blank_to_null(F.col("type")).alias("t")).agg(F.count("*").alias("n"), F.count_if("monitor").alias("on"), F.count_if(browser).alias("browser"))
    rows = cells.groupBy("wba_id").agg(
        F.sum("n").alias("urls_total"), F.sum("on").alias("urls_monitored"), F.sum("browser").alias("browser_lane"),
        F.bool_or(F.col("t") == "reports_hub").alias("_hub"), F.bool_or(F.col("t") == "sustainability_page").alias("_page"), F.collect_list(F.struct("t", "n")).alias("cells"),
    )
    counted = lambda v, own: F.concat(v, F.lit(": "), _total(own).cast("string"))
    lines = _by(F.filter("cells", lambda x: x["t"].isNotNull()), "t", counted, lambda v, own: F.struct((-_total(own)).alias("n"), v.alias("v")), "\n")
    return rows.withColumn("pages_breakdown", lines).drop("cells")


def coverage_full(companies: DataFrame, pages: DataFrame, library: DataFrame, *, year_min: int) -> DataFrame:
    """One row a company: rec_id, wba_id and all statistics; each table is scanned once.

    Companies without any row get zeros and their flags; companies, rows and pages with a blank or null id are left
    out; empty tables count as no rows; of repeated companies each has its row.
    """
    out = companies.select("rec_id", blank_to_null(F.col("wba_id")).alias("wba_id")).filter("wba_id is not null")
    out = out.join(entity_docs(library), "wba_id", "left").join(entity_pages(pages), "wba_id", "left")
    zero = [c for c in ("urls_total", "urls_monitored", "browser_lane", "docs_total", "docs_with_file", "docs_typed", "sust_reports_total")]
    texts = {"coverage_breakdown": "", "pages_breakdown": "", "docs_by_year": "", "sust_years": "", "sust_cadence": "none"}
    out = out.fillna(0, zero).fillna(texts)
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    old = lambda c: F.coalesce(F.col(c), F.lit(0)) < year_min
    docs = F.col("docs_total")
    flags = F.array_compact(F.array(
        F.when(F.col("urls_total") == 0, "no_urls").when(F.col("urls_monitored") == 0, "nothing_monitored"),
        F.when(no("_hub"), "no_reports_hub"),
        F.when(no("_page"), "no_sustainability_page"),
        F.when(docs == 0, "no_docs"),
        F.when((docs == 0) & (F.col("browser_lane") > 0), "browser_dependent"),
        F.when((docs > 0) & (F.col("docs_with_file") == 0), "no_files"),
        F.when((docs > 0) & (F.col("docs_typed") == 0), "nothing_typed"),
        F.when(old("_sust"), f"no_sust_report_{year_min}+"),
        F.when(old("_annual"), f"no_annual_report_{year_min}+"),
    ))
    missing = F.array_compact(F.array(F.when(no("_has_sust"), "Sustainability report (any)"), F.when(no("_has_annual"), "Annual report (any)"), *(F.when(no(f"_has{i}"), t) for i, t in enumerate(IMPORTANT))))
    out = out.withColumns({"coverage_flags": F.array_join(flags, "; "), "missing_types": F.array_join(missing, "; ")})
    return out.select("rec_id", "wba_id", *STATS)


def coverage_changed(current: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``target`` that differ from ``current`` (by rec_id) in a statistic, both in comparable form."""
    form = lambda df, c: blank_to_null(F.col(f"{df}.{c}").cast("string"))
    differs = F.lit(False)
    for c in STATS:
        differs = differs | ~form("a", c).eqNullSafe(form("b", c))
    return target.alias("b").join(current.alias("a"), F.col("a.rec_id") == F.col("b.rec_id"), "left").filter(differs).select("b.*")


def coverage_orphans(companies: DataFrame, library: DataFrame, k: int = 10) -> DataFrame:
    """wba_id, docs_total: entities with documents but no company, the largest ``k``."""
    return coverage_docs(library).join(companies.select("wba_id"), "wba_id", "left_anti").select("wba_id", "docs_total").orderBy(F.desc("docs_total"), "wba_id").limit(k)
