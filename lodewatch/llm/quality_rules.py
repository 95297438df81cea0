"""Quality rules from line frequency across documents, in DataFrame expressions only.

Lines are normalised (lower case, white space collapsed) and hashed; for each host the distinct documents that
hold a line are counted. Lines in more than ``max_share`` of a host's documents, and in more than ``min_docs``, are
boilerplate there and go; a document left with under ``min_left`` of its words is depleted. Beside it stand
per-document base figures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text

_BLANK = r"[ \x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words are runs of anything but space and U+0009 to U+000D."""
    return F.array_remove(F.split(text, _BLANK), "")


def _let(value: Column, body) -> Column:
    """Evaluates ``value`` once and hands it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Window hashes are sorted with their positions; equal neighbours are repeats. In texts of fewer than 65,536 words both
    are packed into one long, 48 bits of it hash, in longer ones they stand side by side. Two different windows of a text
    are taken for equal with a chance below 1 in 100,000.
    """

    def repeated(s: Column, key: Callable[[Column], Column], at: Callable[[Column], Column]) -> Column:
        same = lambda x, i, j: F.coalesce(key(x) == key(F.get(s, i + j)), F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i, -1) | same(x, i, 1)), at))

    def covered(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")), lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def with_hashes(h: Column) -> Column:
        packed = F.transform(h, lambda x, i: F.shiftleft(x, 16).bitwiseOR(i.cast("long")))
        beside = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i")))
        short = _let(F.sort_array(packed), lambda s: covered(repeated(s, lambda x: F.shiftright(x, 16), lambda x: x.bitwiseAND(F.lit(65535)))))
        long = _let(F.sort_array(beside), lambda s: covered(repeated(s, lambda x: x["h"], lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).when(F.size(h) < 65536, short).otherwise(long)

    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_let(hashes, with_hashes))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def normal_line(line: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(line, _BLANK, " ")))


def line_quality(docs: DataFrame, *, max_share: float = 0.1, min_docs: int = 5, min_left: float = 0.3, min_words: int = 50, max_repeat: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a row of ``docs``: doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_line_words, boilerplate (positions of lines), base_failed, kept.

    A null text has no words (base_failed); a null host is a host of its own; an empty table gives no row. Rows that are
    equal in id and text are one document to the counts, and each keeps its row; rows without an id are told apart by
    their texts. Counts cover all documents; a line that stands in a third of them is pre-aggregated before it is shuffled.
    """
    rows = id_text(docs, id_col, text_col, host=host_col).withColumn("same", F.xxhash64("text"))
    # Each document's lines once, as hashes and numbers of words; blank lines have no words. No line's text is dealt out.
    words_in = lambda k: F.when(k == "", F.lit(0)).otherwise(F.size(F.split(k, " ")))
    each = F.transform(F.transform(_lines(F.col("text")), normal_line), lambda k: F.struct(F.xxhash64(k).alias("key"), words_in(k).alias("n")))
    held = cut(rows.select("doc_id", "host", "same", each.alias("lines")).dropDuplicates(["doc_id", "host", "same"]), "lines")
    lines = held.select("doc_id", "host", "same", F.posexplode("lines").alias("pos", "line")).select("doc_id", "host", "same", "pos", "line.key", F.col("line.n").cast("long").alias("n")).filter("n > 0")
    # No line can be boilerplate at the least limit, so few are left for the join with their hosts' sizes.
    once = lines.groupBy("host", "key", "doc_id", "same").agg(F.lit(1).alias("one"))
    often = once.groupBy("host", "key").agg(F.count("*").alias("n")).filter(F.col("n") > min_docs).select(F.col("host").alias("host_"), F.col("key").alias("key_"), "n")
    hosts = held.groupBy("host").agg(F.count("*").alias("documents"))
    frequent = often.join(hosts, F.col("host").eqNullSafe(F.col("host_"))).filter(F.col("n") > F.lit(max_share) * F.col("documents")).select("host_", "key_")
    hit = lines.join(frequent, F.col("host").eqNullSafe(F.col("host_")) & (F.col("key") == F.col("key_")), "left_semi")
    per_doc = hit.groupBy("doc_id", "host", "same").agg(F.sum("n").alias("n_line_words"), F.sort_array(F.collect_list("pos")).alias("boilerplate"))
    b = per_doc.select(F.col("doc_id").alias("d"), F.col("host").alias("h"), F.col("same").alias("s"), "n_line_words", "boilerplate")

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w, n).alias("n_repeat_words"))

    full = F.filter(_lines(F.col("text")), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    # Words are bound inside the expression, so that a filter pushed below cannot split the text for each of them.
    own = rows.select(
        "doc_id", "host", "same", "text",
        _let(words_of(F.col("text")), of_words).alias("w"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]++", "")).cast("long").alias("n_symbols"),
        _let(full, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    ).select("doc_id", "host", "same", "text", "w.*", "n_symbols", "n_dup_lines")
    joined = own.join(b, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("host").eqNullSafe(F.col("h")) & (F.col("same") == F.col("s")), "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_line_words") < min_left * F.col("n_words")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted).drop("d", "h", "s", "same", "host")


def clean_text(judged: DataFrame) -> DataFrame:
    """doc_id, text without its boilerplate lines, for the documents that ``line_quality`` keeps.

    Repeated rows stay; a null text is never kept there; an empty table gives no row.
    """
    left = F.array_join(F.filter(_lines(F.col("text")), lambda x, i: ~F.array_contains("boilerplate", i)), "\n")
    return judged.filter("kept").select("doc_id", F.when(F.col("boilerplate").isNull(), F.col("text")).otherwise(left).alias("text"))
