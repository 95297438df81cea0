"""Secrets and who owns them, in DataFrame expressions only.

Candidates are what the fixed patterns find and, beyond them, long mixed tokens. For each candidate's hash the distinct
repositories and owners that hold it are counted over the whole corpus: a value that many owners have copied, or that
more than one owner has in many repositories, is an example; one that fewer hold looks live. Mixed tokens are only
taken as secrets if they look live.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text
from lodewatch.llm._spans import matches

KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs of fewer signs fail whole, so asking for the length at once finds the same matches.
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"
#: A whole run of 20 signs or more with a capital, a small letter and two digits, tried once for each run.
MIXED = r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/_=-]*+[A-Z])(?=[A-Z0-9+/_=-]*+[a-z])(?=[A-Za-z+/_=-]*+[0-9][A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
#: Spans (and four for a document's own cells) that may be broadcast, of 8 bytes each; beyond it the texts are shuffled.
_BROADCAST_SPANS = 4_000_000


def base_spans(text: Column) -> dict[str, Column]:
    """The three kinds' spans; the value is what is secret. Failing matches are dropped, without another try inside them."""
    return {
        "assign": F.filter(matches(text, ASSIGN, text.rlike("[:=]"), group=1), lambda s: F.length(s["value"]) >= 6),
        "access": matches(text, ACCESS, F.instr(text, "AKIA") > 0),
        "hex": matches(text, HEX, text.rlike("[0-9a-f]{24}")),
    }


def find_secrets(docs: DataFrame, *, min_copiers: int = 5, min_repos: int = 20, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One row a row of ``docs``: doc_id, text, assign, access, hex (base spans), mixed (spans the method adds).

    A span is start, end, hash, repos, owners, example; ``example`` is true if ``min_copiers`` owners or more hold
    the value, or two owners or more in ``min_repos`` repositories or more. Each document is its own repository unless ``repo_col`` names one. A null text is empty; null owners
    are one owner; repeated rows each keep their spans; an empty table gives no row. Counts are over all rows and pre-aggregated before a shuffle,
    so a value that a third of all rows hold is no group of its own.
    """
    rows = id_text(docs, id_col, text_col, owner=owner_col, **({"repo": repo_col} if repo_col else {}))
    rows = rows.withColumns({"owner": F.coalesce(F.col("owner").cast("string"), F.lit("")), "repo": F.coalesce(F.col("repo" if repo_col else "doc_id").cast("string"), F.lit("")), "same": F.xxhash64("text")})
    keep = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("hash")))
    text = F.col("text")
    found = rows.select("doc_id", "same", "owner", "repo", *(keep(s).alias(k) for k, s in base_spans(text).items()), keep(matches(text, MIXED, text.rlike("[A-Za-z0-9+/_=-]{20}"))).alias("mixed"))
    # A mixed token that touches a base span is that span's.
    touches = lambda m: F.exists(F.concat(*map(F.col, KINDS)), lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
    base = cut(found.withColumn("mixed", F.when(F.size("mixed") > 0, F.filter("mixed", lambda m: ~touches(m))).otherwise(F.col("mixed"))), "secrets")

    each = cut(base.filter(F.size(F.concat(*KINDS, "mixed")) > 0).select("doc_id", "same", "owner", "repo", F.explode(F.array_distinct(F.transform(F.concat(*KINDS, "mixed"), lambda s: s["hash"]))).alias("hash")), "secret-values")
    held = cut(each.groupBy("hash").agg(F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners")), "secret-owners")
    known = each.select("doc_id", "same", "hash").join(held, "hash").dropDuplicates(["doc_id", "same", "hash"]).groupBy("doc_id", "same").agg(F.collect_list(F.struct("hash", "repos", "owners")).alias("k"))
    known = known.select(F.col("doc_id").alias("d"), F.col("same").alias("t"), F.map_from_entries(F.transform("k", lambda x: F.struct(x["hash"], F.struct(x["repos"].alias("repos"), x["owners"].alias("owners"))))).alias("known"))
    joined = base.join(known, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("same") == F.col("t")), "left")

    def told(spans: Column) -> Column:
        at = lambda s: F.element_at("known", s["hash"])
        copied = lambda k: (k["owners"] >= min_copiers) | ((k["owners"] >= 2) & (k["repos"] >= min_repos))
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hash"].alias("hash"), at(s)["repos"].alias("repos"), at(s)["owners"].alias("owners"), copied(at(s)).alias("example")))

    live = F.filter(told(F.col("mixed")), lambda s: ~s["example"])
    return joined.select("doc_id", *(told(F.col(k)).alias(k) for k in KINDS), live.alias("mixed"), "same")


def span_texts() -> tuple[Column, Column, Column]:
    """(base spans, all spans, verdicts on all): ``kind:start:end`` by start, then kind as listed, comma-joined; a verdict is ``example`` or ``live`` and owners."""

    def joined(kinds: tuple[str, ...], text: Callable[[str, Column], Column]) -> Column:
        one = lambda k, n: F.transform(k, lambda s: F.struct(s["start"], F.lit(n).alias("n"), text(k, s).alias("tag")))
        return F.array_join(F.transform(F.array_sort(F.concat(*(one(k, n) for n, k in enumerate(kinds)))), lambda s: s["tag"]), ",")

    place = lambda k, s: F.concat(F.lit(f"{k}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    verdict = lambda k, s: F.concat(F.when(s["example"], "example:").otherwise("live:"), s["owners"].cast("string"))
    return joined(KINDS, place), joined((*KINDS, "mixed"), place), joined((*KINDS, "mixed"), verdict)


def redact(docs: DataFrame, *, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None, **limits) -> DataFrame:
    """``docs`` with every secret that does not count as an example replaced by ``mark``; no row goes, other columns stay.

    A null text stays null; overlapping spans are replaced as one; repeated rows are each edited; an empty table stays
    empty. Texts are not shuffled where the spans of documents with live secrets are few enough to be broadcast.
    """
    c = lambda name: F.col(f"`{name}`")
    inner = docs.select(F.struct(*map(c, docs.columns)).alias("row"), c(id_col).alias("doc_id"), c(text_col).cast("string").alias("text"))
    found = find_secrets(docs, id_col=id_col, text_col=text_col, owner_col=owner_col, repo_col=repo_col, **limits)
    live = F.filter(F.concat(*KINDS, "mixed"), lambda s: ~s["example"])
    spans = F.array_sort(F.transform(live, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    hit = cut(found.select(F.col("doc_id").alias("d"), F.col("same").alias("t"), spans.alias("spans")).filter(F.size("spans") > 0).dropDuplicates(["d", "t"]), "live-secrets")
    few = hit.agg(F.sum(F.size("spans") + 4)).first()[0] or 0
    hit = F.broadcast(hit) if few <= _BROADCAST_SPANS else hit
    joined = inner.join(hit, F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("t")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(s: Column, x: Column) -> Column:
        more = F.when(x["start"] >= s["at"], F.concat(s["out"], F.substr("text", s["at"] + 1, x["start"] - s["at"]), F.lit(mark))).otherwise(s["out"])
        return F.struct(more.alias("out"), F.greatest(s["at"], x["end"]).alias("at"))

    edited = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substr("text", s["at"] + 1, F.length("text"))))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(edited)
    return joined.select(*(text.alias(x) if x == text_col else F.col(f"row.`{x}`").alias(x) for x in docs.columns))
