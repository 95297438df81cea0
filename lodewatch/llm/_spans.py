"""Regex matches with their character positions, in DataFrame expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for a row and hands it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sum(values: Column) -> Column:
    """Running sums of an array<int>, folded in chunks so that long arrays stay far from quadratic."""

    def fold(part: Column, start: Column) -> Column:
        empty = F.struct(F.array().cast("array<int>").alias("a"), start.alias("t"))
        return F.aggregate(part, empty, lambda s, x: F.struct(F.concat(s["a"], F.array(s["t"] + x)).alias("a"), (s["t"] + x).alias("t")), lambda s: s["a"])

    def by_chunk(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x))
        return let(fold(totals, F.lit(0)), lambda upto: F.flatten(F.transform(chunks, lambda c, k: fold(c, F.when(k == 0, F.lit(0)).otherwise(F.get(upto, k - 1))))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")), lambda k: F.slice(values, k * _CHUNK + 1, _CHUNK))
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).when(F.size(values) <= _CHUNK, fold(values, F.lit(0))).otherwise(let(chunks, by_chunk))


def matches(text: Column, pattern: str, worth: Column, group: int = 0, around: Callable[[Column, Column, Column], Column] | None = None, kind: str = "") -> Column:
    """array<struct<start,end,value>> of leftmost non-overlapping matches; positions in code points, end exclusive.

    ``value`` is the group's text. ``worth`` is a cheap test: where it is false there can be no match. The pattern must
    not match an empty string. ``around`` adds a field of that name and of type ``kind``, made of all matches, the
    pieces of text between them (one more) and the match's number.
    """
    more = f",around:{kind}" if around else ""
    none = F.array().cast(f"array<struct<start:int,`end`:int,value:string{more}>>")
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.lit(None).cast("array<string>")).alias("g"))

    def build(q: Column) -> Column:
        ends = running_sum(F.transform(q["m"], lambda x, i: F.length(F.get(q["p"], i)) + F.length(x)))
        value = (lambda x, i: F.get(q["g"], i)) if group else lambda x, i: x
        extra = (lambda i: [around(q["m"], q["p"], i).alias("around")]) if around else lambda i: []
        return let(ends, lambda e: F.transform(q["m"], lambda x, i: F.struct((F.get(e, i) - F.length(x)).alias("start"), F.get(e, i).alias("end"), value(x, i).alias("value"), *extra(i))))

    return F.when(worth, let(found, build)).otherwise(none)


def tags(kind: str, spans: Column) -> Column:
    """``kind:start:end`` texts."""
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))
