"""File acquisition and cover text: work queues and outcome states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
RETRYABLE = ("parse_fail", "not_pdf", "truncated", "download_fail")
FINAL_STATUS = {"not_found": "gone", "forbidden": "blocked", "too_big": "too_big", "not_pdf": "not_pdf"}
LARGEST = 5_000_000


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def _has_file() -> Column:
    return F.coalesce(F.col("has_file"), F.lit(False))


def _year_at_least(name: str, least: int) -> Column:
    text = F.col(name).cast("string")
    return F.coalesce(text.rlike("^[0-9]+$") & (F.expr(f"try_cast({name} as int)") >= least), F.lit(False))


def select_attach(rows: DataFrame, *, types: tuple[str, ...] | None = None, year_min: int | None = None, every: bool = False) -> DataFrame:
    """Rows with a URL, no file and no final status; only classified ones unless ``every``."""
    out = rows.filter(~_blank("document_url") & ~_has_file() & _blank("file_status"))
    out = out if every else out.filter(~_blank("source_type"))
    out = out.filter(F.col("source_type").isin(*types)) if types else out
    return out.filter(_year_at_least("doc_year", year_min)) if year_min else out


def select_missing(rows: DataFrame, *, types: tuple[str, ...] | None = None, year_min: int | None = None, limit: int | None = None) -> DataFrame:
    """The same without asking for a type, at most ``limit`` rows by rec_id."""
    out = select_attach(rows, types=types, year_min=year_min, every=True)
    return out.orderBy("rec_id").limit(limit) if limit else out


def missing_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(~_blank("document_url") & ~_blank("source_type") & ~_has_file())


def cover_todo(rows: DataFrame) -> DataFrame:
    return rows.filter(_has_file() & _blank("cover_status"))


def reclaim(rows: DataFrame) -> DataFrame:
    """rec_id, cover_status (NULL): failed rows to put back into the queue."""
    return rows.filter(F.col("cover_status").isin(*RETRYABLE)).select("rec_id", F.lit(None).cast("string").alias("cover_status"))


def _refused(status: Column):
    return F.when(status.isin(401, 403), "forbidden").when(status.isin(404, 410), "not_found")


def probe_outcome(status: Column, magic: Column, content_type: Column) -> Column:
    """What a look at the first bytes tells; NULL status is a failed request."""
    pdf = F.coalesce(F.startswith(magic, F.lit("%PDF")), F.lit(False)) | F.coalesce(F.lower(content_type).contains("application/pdf"), F.lit(False))
    return F.when(status.isNull(), "error").when((status == 200) & pdf, "ok_pdf").when(status == 200, "not_pdf_200").otherwise(F.coalesce(_refused(status), F.lit("other_4xx_5xx")))


def download_outcome(status: Column, size: Column, magic: Column, largest: int = LARGEST) -> Column:
    refused = F.when(status.isNull(), "error").otherwise(F.coalesce(_refused(status), F.when(status != 200, "other")))
    return F.coalesce(refused, F.when(size > largest, "too_big").when(~F.coalesce(F.startswith(magic, F.lit("%PDF")), F.lit(False)), "not_pdf").otherwise("ok"))


def file_status(outcome: Column) -> Column:
    """The status that an outcome leaves on the row: final ones have one, the rest are tried again (NULL)."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in FINAL_STATUS.items() for x in kv)), outcome)


def cover_outcome(content: Column, declared_size: Column, parsed: Column, text: Column) -> Column:
    """The state of a downloaded cover: (binary body, content length, whether it parsed, text of its first pages)."""
    tail = F.substring(content, -2048, 2048)
    whole = F.hex(tail).contains("2525454F46")  # %%EOF
    return (
        F.when(content.isNull(), "download_fail")
        .when(F.hex(F.substring(content, 1, 4)) != "25504446", "not_pdf")
        .when((F.octet_length(content) < F.coalesce(declared_size, F.lit(0))) | ~whole, "truncated")
        .when(~F.coalesce(parsed, F.lit(False)), "parse_fail")
        .when(F.coalesce(F.trim(text), F.lit("")) == "", "no_text")
        .otherwise("ok")
    )


def diagnose_verdict(url: Column, content: Column, opened: Column, text_chars: Column, page_count: Column) -> Column:
    """A wordier verdict for one file: no_url, dl_err, not_pdf, reader_fail, text_ok_len_fail, no_text, parse_fail or ok.

    The two probes of a file that opened are apart: ``text_chars`` of its first page and ``page_count``, each NULL if
    its probe failed. A file cut short gets the verdict of its probes.
    """
    some = F.coalesce(text_chars, F.lit(0)) > 0
    probes = F.when(some & page_count.isNull(), "text_ok_len_fail").when(some, "ok").when(page_count.isNotNull(), "no_text").otherwise("parse_fail")
    return (
        F.when(F.coalesce(F.trim(url), F.lit("")) == "", "no_url")
        .when(content.isNull(), "dl_err")
        .when(F.hex(F.substring(content, 1, 4)) != "25504446", "not_pdf")
        .when(~F.coalesce(opened, F.lit(False)), "reader_fail")
        .otherwise(probes)
    )


def outcome_histogram(rows: DataFrame, by: str = "outcome") -> DataFrame:
    """outcome, n, percent of all rows."""
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(rows.agg(F.count("*").alias("_all")))).select(by, "n", F.round(100.0 * F.col("n") / F.col("_all"), 1).alias("percent"))


def random_sample(rows: DataFrame, n: int, seed: int = 0, by: str = "document_url") -> DataFrame:
    """``n`` rows in seeded hash order, a distributed top-k; the same rows each time. A null counts as ''; repeated rows are equals."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed} "), F.coalesce(F.col(by).cast("string"), F.lit("")))), by).limit(n)
