"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts. DataFrame expressions only.

What the fixed patterns find seeds the bootstrap. The two words before a seed are a lexical pattern, and so are the
words on both its sides; identifier-like tokens (with a digit, four signs or more, outside every fixed match) are
instances of the patterns around them. Scores pass to and fro over the graph of distinct (pattern, instance) pairs: a
pattern's confidence is the mean score of its instances, an instance's score the confidence of its best pattern, seeds
stay at 1. Scores only ever rise, and once none moves by more than a hundredth, patterns of enough seeds and confidence
mark the unseen identifiers that stand in them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text
from lodewatch.llm._spans import let, matches, tags

KINDS = ("email", "ip", "card", "phone")
#: Possessive forms of the fixed patterns. A match starts at a run's first character or where the match before ended,
#: which is where a leftmost match starts; without this a long run would be tried from each of its characters.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: A whole token with a digit, tried once for each token.
TOKEN = r"(?<![^\s])(?=[^\s0-9]*+[0-9])[^\s]{4,}+"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a text of 13 to 19 digits passes the Luhn test."""

    def add(s: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return s + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def base_spans(text: Column, around: bool = False) -> dict[str, Column]:
    """The four kinds' spans, with the patterns around them if asked for; failing matches are dropped, without another try inside them."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    found = lambda pattern, worth: matches(text, pattern, worth, around=_patterns if around else None, kind="array<string>")
    return {
        "email": found(EMAIL, F.instr(text, "@") > 0),
        "ip": F.filter(found(IP, text.rlike(r"[0-9]\.[0-9]")), lambda s: s["value"].rlike(rf"^{part}\.{part}\.{part}\.{part}$")),
        "card": F.filter(found(CARD, text.rlike(r"[0-9](?:[ -]?[0-9]){12}")), lambda s: let(_digits(s["value"]), luhn)),
        "phone": F.filter(found(PHONE, text.rlike(r"\+[0-9]")), lambda s: F.length(_digits(s["value"])).between(9, 15)),
    }


def _patterns(found: Column, pieces: Column, i: Column) -> Column:
    """The lexical patterns around match ``i``: the two words before it, and the words on both its sides, lower-cased.

    Words may reach over three earlier matches of the same kind; a pattern whose words are not within reach is left out.
    """
    own = F.get(pieces, i)
    reach = F.concat_ws("", F.when(i <= 3, "\n"), *(x for k in (3, 2, 1) for x in (F.get(pieces, i - k), F.get(found, i - k))), own)
    two = r"\s([^\s]++\s++[^\s]++)\s*+$"
    near = F.regexp_extract(F.right(own, F.lit(200)), two, 1)  # mostly enough, and far shorter
    before = F.when(near != "", near).otherwise(F.regexp_extract(reach, two, 1))
    after = F.regexp_extract(F.get(pieces, i + 1), r"^\s*+([^\s]++)", 1)

    def named(x: Column) -> Column:
        last = F.substring_index(x["before"], " ", -1)
        sides = F.when((x["before"] != "") & (x["after"] != ""), F.concat(last, F.lit(" _ "), x["after"]))
        return F.filter(F.array(F.when(x["before"] != "", x["before"]), sides), lambda p: p.isNotNull())

    words = F.struct(F.regexp_replace(F.lower(before), r"\s+", " ").alias("before"), F.lower(after).alias("after"))
    return let(words, named)


def find_personal(docs: DataFrame, *, min_seeds: int = 3, min_confidence: float = 0.5, tolerance: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, email, ip, card, phone (arrays of start, end, value), found (likewise, by contexts).

    A null text is empty and has no spans; repeated rows each keep theirs; an empty table gives no row. All documents
    take part in the scores. Pairs are made distinct before they are joined, so copies of a document weigh once, and a
    pattern that a third of all rows share is summed before it is shuffled.
    """
    rows = id_text(docs, id_col, text_col).withColumn("same", F.xxhash64("text"))
    found = rows.select("doc_id", "same", "text", *(s.alias(k) for k, s in base_spans(F.col("text"), around=True).items()))
    # A mask for each kind, one byte a character, "1" inside a match: a token's test then costs what its own length costs.
    blank = lambda n, c: F.repeat(F.lit(c), n)

    def mask(k: str) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col(k), i - 1)["end"])
        return F.encode(F.array_join(F.transform(k, lambda s, i: F.concat(blank(s["start"] - before(i), "0"), blank(s["end"] - s["start"], "1"))), ""), "US-ASCII")

    def outside(masks: Column) -> Column:
        inside = lambda c: F.exists(masks, lambda m: F.substr(m, c["start"] + 1, c["end"] - c["start"]).cast("string").contains("1"))
        return F.filter(matches(F.col("text"), TOKEN, F.col("text").rlike("[0-9]"), around=_patterns, kind="array<string>"), lambda c: ~inside(c))

    free = let(F.array(*(mask(k) for k in KINDS)), outside)
    base = cut(found.withColumn("free", free).select("doc_id", "same", *KINDS, "free"), "personal")

    around = lambda k, is_seed: base.select(F.explode(k).alias("s")).select(F.explode("s.around").alias("p"), "s.value").select(F.xxhash64("p").alias("pattern"), F.xxhash64("value").alias("instance"), F.lit(is_seed).alias("seed"))
    edges = reduce(DataFrame.unionByName, [*(around(k, True) for k in KINDS), around("free", False)]).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    sure = _confident(cut(edges, "edges"), min_seeds, tolerance).filter(F.col("confidence") >= min_confidence).select("pattern")
    marked = base.select("doc_id", "same", F.explode("free").alias("s")).select("doc_id", "same", F.struct("s.start", "s.end", "s.value").alias("s"), F.explode("s.around").alias("p")).withColumn("pattern", F.xxhash64("p"))
    more = marked.join(sure, "pattern", "left_semi").dropDuplicates(["doc_id", "same", "s"]).groupBy("doc_id", "same").agg(F.sort_array(F.collect_list("s")).alias("found")).select(F.col("doc_id").alias("d"), F.col("same").alias("t"), "found")
    joined = base.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("same") == F.col("t")), "left")
    plain = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    empty = F.array().cast(dict(more.dtypes)["found"])
    return joined.select("doc_id", *(plain(k).alias(k) for k in KINDS), F.coalesce("found", empty).alias("found"))


def _confident(edges: DataFrame, min_seeds: int, tolerance: float) -> DataFrame:
    """pattern, confidence of the patterns of ``min_seeds`` seeds or more, once scores have settled.

    Only edges of such patterns take part, and of them only instances that more than one pattern holds can pass a score on.
    """
    worth = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.count("*").alias("n")).filter(F.col("seeds") >= min_seeds)
    trusted = cut(worth.withColumn("confidence", F.col("seeds") / F.col("n")), "patterns")
    linked = cut(edges.filter("not seed").join(trusted.select("pattern"), "pattern", "left_semi"), "linked")
    while True:  # a confidence that moves rises by ``tolerance`` or more and none exceeds 1, so this ends
        best = cut(linked.join(trusted, "pattern").groupBy("instance").agg(F.max("confidence").alias("best")), "instances")
        gained = linked.join(best, "instance").groupBy("pattern").agg(F.sum("best").alias("gain"))
        score = (F.col("seeds") + F.coalesce("gain", F.lit(0.0))) / F.col("n")
        now = cut(trusted.join(gained, "pattern", "left").select("pattern", "seeds", "n", score.alias("confidence"), (score - F.col("confidence")).alias("rise")), "patterns")
        trusted = now.drop("rise")
        if now.filter(F.col("rise") > tolerance).isEmpty():
            return trusted.select("pattern", "confidence")


def span_texts(found: DataFrame) -> tuple[Column, Column]:
    """(base spans, all spans) as ``kind:start:end`` by kind, then start, comma-joined."""
    base = [tags(k, F.col(k)) for k in KINDS]
    return F.array_join(F.concat(*base), ","), F.array_join(F.concat(*base, tags("context", F.col("found"))), ",")
