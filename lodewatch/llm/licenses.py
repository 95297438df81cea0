"""Licence recognition by sentences, in DataFrame expressions only.

A text is cut into sentences, each is normalised and looked up among known licence sentences; a wrapped sentence is
looked up whole before its lines are, and signs of comments at the ends of lines do not count. The identifiers' sequence is matched against ordered rules, each of which takes its part of the sequence out before the next one looks.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import id_text
from lodewatch.llm._spans import let

#: (identifier, normalised sentence). "<year>" stands for a number of four digits and "<n>" for a version.
SENTENCES = [
    ("MITref", "released under the mit license"),
    ("MITref", "licensed under the mit license"),
    ("MITref", "this project is licensed under the mit license"),
    ("MITtitle", "the mit license"),
    ("MITtitle", "mit license"),
    ("MITgrant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("MITnotice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("NoWarranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("NoLiability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("Apache2ref", "licensed under the apache license version 2.0"),
    ("Apache2ref", "licensed under the apache license version 2.0 the license"),
    ("Apache2not", "you may not use this file except in compliance with the license"),
    ("Apache2get", "you may obtain a copy of the license at http www apache org licenses license 2.0"),
    ("Apache2asis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("GPLref", "this work is licensed under the gnu general public license version <n>"),
    ("GPLref", "licensed under the gnu general public license version <n>"),
    ("GPLfree", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <n> of the license or at your option any later version"),
    ("GPLhope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("LGPLref", "licensed under the gnu lesser general public license version <n>"),
    ("BSDredist", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("CCBYNCref", "licensed under cc by nc <n>"),
    ("CCBYSAref", "licensed under cc by sa <n>"),
    ("CCBYref", "licensed under cc by <n>"),
    ("CC0ref", "released under cc0 <n>"),
    ("CC0ref", "this work is dedicated to the public domain"),
    ("MPLref", "this source code form is subject to the terms of the mozilla public license v <n>"),
    ("AllRights", "all rights reserved"),
]
#: (licence, sequence of identifiers, class), in order: a whole text before a mere mention.
RULES = [
    ("MIT", ("MITtitle", "MITgrant", "MITnotice", "NoWarranty", "NoLiability"), "permissive"),
    ("MIT", ("MITgrant", "MITnotice", "NoWarranty", "NoLiability"), "permissive"),
    ("MIT", ("MITref",), "permissive"),
    ("MIT", ("MITtitle",), "permissive"),
    ("Apache-2.0", ("Apache2ref", "Apache2not", "Apache2get", "Apache2asis"), "permissive"),
    ("Apache-2.0", ("Apache2ref",), "permissive"),
    ("GPL", ("GPLfree", "GPLhope"), "copyleft"),
    ("GPL", ("GPLfree",), "copyleft"),
    ("GPL", ("GPLref",), "copyleft"),
    ("LGPL", ("LGPLref",), "copyleft"),
    ("BSD", ("BSDredist", "NoWarranty"), "permissive"),
    ("BSD", ("BSDredist",), "permissive"),
    ("CC-BY-NC", ("CCBYNCref",), "noncommercial"),
    ("CC-BY-SA", ("CCBYSAref",), "copyleft"),
    ("CC-BY", ("CCBYref",), "permissive"),
    ("CC0", ("CC0ref",), "permissive"),
    ("MPL", ("MPLref",), "copyleft"),
    ("Proprietary", ("AllRights",), "restricted"),
]
_WORTH = r"licen[sc]e|permission|redistribut|public domain|free software|cc0|as is|rights reserved|liable"
#: Where a text is cut, coarse to fine: sentences (a URL set apart belongs to what stands before it), clauses, lines. What is known is cut no further.
_CUTS = (r"[.!?]+\s+|[.!?]+$|:[ \t\r]*\n(?!\s*https?://)|\n[ \t\r]*\n(?!\s*https?://)", r";+\s+", r"\n+")
#: Signs of comments at a line's start and end.
_COMMENT = r"(?m)^[ \t]*(?:<!--+|/?\*+/?|//+|#+|;+|--+|%+)[ \t]*|[ \t]*(?:\*+/?|--+>)[ \t\r]*$"
_VERSION = r"(?<![a-z0-9])[0-9]+(?:\.[0-9]+)*$|(?<=version )[0-9]+(?:\.[0-9]+)*"


def normalised(sentence: Column) -> Column:
    """Lower case, words apart by one space, punctuation gone but for the point of a number; version numbers become <n> except 2.0."""
    plain = F.regexp_replace(F.lower(sentence), r"(?<![0-9])\.|\.(?![0-9])|[^a-z0-9.]+", " ")
    plain = F.trim(F.regexp_replace(plain, r"\s+", " "))
    return F.when(plain.rlike(r"apache license"), plain).otherwise(F.regexp_replace(plain, _VERSION, "<n>"))


def known_sentences(sentences: list[tuple[str, str]]) -> dict[str, str]:
    """Known sentences as given and as normalisation leaves them, each with its identifier."""
    return {text: name for name, text in sentences} | {re.sub(_VERSION, "<n>", text): name for name, text in sentences if "apache license" not in text}


def _worth(sentences: list[tuple[str, str]]) -> str:
    """A pattern that every text with a known sentence matches: the common words, and the longest word of each sentence that has none of them."""
    more = {max(re.findall("[a-z0-9]+", text), key=len) for _, text in sentences if not re.search(_WORTH, text)}
    return "(?i)" + "|".join([_WORTH, *sorted(more)]).replace(" ", "[^a-z0-9]+")


def scan_licenses(docs: DataFrame, *, sentences: list[tuple[str, str]] | None = None, rules: list[tuple[str, tuple[str, ...], str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, sentence_ids (known sentences in order), licenses (distinct, in the rules' order), classes, n_matched, n_unmatched.

    Sentences that are not known stand between known ones without breaking a sequence. ``n_matched`` counts matches of
    rules, ``n_unmatched`` known sentences no rule has taken. A null or empty text has none; repeated rows stay.
    The sentences and rules are parameters of fixed size and travel with the plan; there is no shuffle.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    rows = id_text(docs, id_col, text_col)
    known = F.create_map(*(F.lit(x) for pair in known_sentences(sentences).items() for x in pair))
    worth = _worth(sentences)

    def identified(part: Column, cuts: tuple[str, ...]) -> Column:
        pieces = F.filter(F.split(part, cuts[0]), lambda s: s.rlike(worth))
        name = lambda s: F.element_at(known, normalised(s))
        if len(cuts) == 1:
            return F.transform(pieces, name)
        return F.flatten(F.transform(pieces, lambda s: let(name(s), lambda x: F.when(x.isNotNull(), F.array(x)).otherwise(identified(s, cuts[1:])))))

    ids = F.filter(identified(F.regexp_replace("text", _COMMENT, ""), _CUTS), lambda x: x.isNotNull())
    found = F.when(F.col("text").rlike(worth), ids).otherwise(F.array().cast("array<string>"))
    out = rows.select("doc_id", found.alias("sentence_ids"))
    # The sequence as text: ";a;;b;". A rule's matches become ";!;", which no later rule takes for a sentence.
    none = F.struct(F.lit("").alias("left"), F.array().cast("array<string>").alias("names"), F.array().cast("array<string>").alias("classes"), F.lit(0).cast("long").alias("n"))
    sequence = F.array_join(F.transform("sentence_ids", lambda x: F.concat(F.lit(";"), x, F.lit(";"))), "")

    def apply(state: Column) -> Column:
        for rule in rules:
            state = let(state, _taker(*rule))
        return state

    state = F.when(F.size("sentence_ids") == 0, none).otherwise(apply(F.struct(sequence.alias("left"), none["names"].alias("names"), none["classes"].alias("classes"), none["n"].alias("n"))))
    done = out.withColumn("state", state)
    left = F.size(F.filter(F.split("state.left", ";"), lambda x: (x != "") & (x != "!"))).cast("long")
    return done.select("doc_id", "sentence_ids", F.array_distinct("state.names").alias("licenses"), F.array_distinct("state.classes").alias("classes"), F.col("state.n").alias("n_matched"), left.alias("n_unmatched"))


def _taker(name: str, ids: tuple[str, ...], kind: str) -> Callable[[Column], Column]:
    """What a rule does to the state: counts its sequence, takes it out and notes the licence."""
    sequence = "".join(f";{x};" for x in ids)

    def take(s: Column) -> Column:
        rest = F.replace(s["left"], F.lit(sequence), F.lit(";!;"))
        times = ((F.length(s["left"]) - F.length(F.replace(s["left"], F.lit(sequence), F.lit("")))) / len(sequence)).cast("long")
        more = F.struct(rest.alias("left"), F.concat(s["names"], F.array(F.lit(name))).alias("names"), F.concat(s["classes"], F.array(F.lit(kind))).alias("classes"), (s["n"] + times).alias("n"))
        return F.when(F.instr(s["left"], sequence) > 0, more).otherwise(s)

    return take
