"""Near-duplicates against brute force, the quality model on held-out labels, licences, and the whole pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodewatch.llm import decontam, licenses, neardup, packing, quality_model
from lodewatch.llm._shingles import shingle_sets
from lodewatch.llm.tokens import encoder, tokenizer_path
from test_text_ops import brute_hits
from texts import APACHE, BSD, GPL, MIT

SF = "/root/testdata/sf0.001"


def shingles(text, words):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def components(docs, words, percent):
    sets = [(d, shingles(t, words)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d)) for d, s in sets}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    r = random.Random(words)
    docs = []
    for g in range(12):  # groups of drifting copies, some near the limit
        text = [f"g{g}w{r.randint(0, 80)}" for _ in range(120)]
        for _ in range(r.choice([1, 2, 3, 8])):
            docs.append(" ".join(text))
            for _ in range(r.choice([0, 1, 3, 6])):
                text[r.randrange(len(text))] = f"x{r.random()}"
    docs += ["", None, "one", "ONE", "one\ttwo", "One  two"] + docs[:3]
    r.shuffle(docs)
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(df, words=words).collect()}
    assert got == components(rows, words, 80)


def exact_components(docs, words, percent):
    """By an exact join on the rarest shingles of each set: linked sets share one of their first n - ceil(0.8 n) + 1."""
    sets = list(shingle_sets([t for _, t in docs], words))
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    root, held, same, links = {d: d for d, _ in docs}, {}, {}, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def link(x, y):
        a, b = sorted((find(docs[x][0]), find(docs[y][0])))
        root[b] = a

    for k in sorted(range(len(sets)), key=lambda k: len(sets[k])):
        x = sets[k]
        if not len(x):
            continue
        if (other := same.setdefault(x.tobytes(), k)) != k:
            link(k, other)
            continue
        rare = x[np.argsort(counts[np.searchsorted(values, x)], kind="stable")][: len(x) + 1 - -(-percent * len(x) // 100)]
        for j in {j for v in rare.tolist() for j in held.get(v, ())}:
            both = np.intersect1d(x, sets[j], assume_unique=True).size
            if 100 * both >= percent * (len(x) + len(sets[j]) - both):
                links += 1
                link(k, j)
        for v in rare.tolist():
            held.setdefault(v, []).append(k)
    return {d: find(d) for d, _ in docs}, links


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_of_10_000_documents(spark, words):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    want, links = exact_components([(r.doc_id, r.text or "") for r in df.collect()], words, 80)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, words=words).collect()} == want and links > 40


def test_near_duplicates_behind_unlike_hubs(spark):
    """Excerpts with lesser ids stand before two versions of a page in every bucket that these share, each too short to be like them."""
    r = random.Random(1)
    page = [f"w{k}" for k in range(1000)]
    rows = [(d, " ".join(r.sample(page, 340))) for d in range(3000)]
    rows += [(9000, " ".join(page)), (9001, " ".join(page[50:] + [f"x{k}" for k in range(50)]))]
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()}
    assert got == {**{d: d for d in range(3000)}, 9000: 9000, 9001: 9000}


def test_near_duplicates_of_odd_rows(spark, odd, empty):
    got = neardup.near_duplicates(odd, words=2).collect()
    assert len(got) == odd.count()
    assert {x.doc_id: x.component_id for x in got if x.doc_id in (4, 5)} == {4: 4, 5: 4}
    assert neardup.near_duplicates(empty).count() == 0


def test_registers_merge_and_estimate():
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    ra, rb, both = neardup.registers(a), neardup.registers(b), neardup.registers(np.arange(0, 1000, dtype=np.uint64))
    assert (np.maximum(ra, rb) == both).all()
    value, lost = neardup.joint_estimate(ra[None], rb[None], np.array([900.0]), np.array([900.0]), 0.8)
    assert abs(value[0] - 0.8) < 0.08 and lost[0] < 5
    far = neardup.registers(np.arange(800, 1700, dtype=np.uint64))
    assert neardup.joint_estimate(ra[None], far[None], np.array([900.0]), np.array([900.0]), 0.8)[1][0] > 25


def test_connected_components_of_long_paths(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100)]
    got = {r.id: r.root for r in neardup.connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_quality_model_on_held_out_labels(spark, odd, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_model.train(docs, labels)
    scored = quality_model.score(docs, model).withColumn("held_out", quality_model.held_out(F.col("doc_id"))).join(labels, "doc_id").filter("held_out").collect()
    right = np.mean([(r.score >= 0.5) == (r.quality == 1) for r in scored])
    assert len(scored) > 50 and right > 0.95
    assert quality_model.score(odd, model).filter("score between 0 and 1").count() == odd.count()
    assert quality_model.score(empty, model).count() == 0
    assert quality_model.keep(odd, model).columns == odd.columns
    untaught = quality_model.train(docs, labels.limit(0))
    assert {round(r.score, 6) for r in quality_model.score(odd, untaught).collect()} == {0.5}


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality_model.fit(x, y, rounds=20).score(x) >= 0.5) == y).mean() > 0.9


def test_licenses(spark, odd, empty):
    mit = "The MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "Intro. Released under the MIT License.\nMore"), (2, "Licensed under the Apache License, Version 2.0."), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "Licensed under CC BY-NC 4.0. Released under the MIT License. Released under the MIT License."), (5, "He lost his driving license."), (6, mit), (7, None), (8, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in range(1, 6)] == [["MIT"], ["Apache-2.0"], ["GPL"], ["MIT", "CC-BY-NC"], []]
    assert got[4].n_matched == 3 and got[4].n_unmatched == 0
    assert got[6].sentence_ids == ["MITtitle", "MITgrant", "MITnotice"] and got[6].licenses == ["MIT"] and got[6].n_unmatched == 2
    assert got[7].sentence_ids == [] and got[8].n_matched == 0 and got[8].n_unmatched == 1
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(empty).count() == 0


def test_wrapped_licenses(spark):
    mit, apache, gpl, bsd = MIT, APACHE, GPL, BSD
    want = [("MIT", ["MITtitle", "MITgrant", "MITnotice", "NoWarranty", "NoLiability"], mit), ("Apache-2.0", ["Apache2ref", "Apache2not", "Apache2get", "Apache2asis"], apache), ("GPL", ["GPLfree", "GPLhope"], gpl), ("BSD", ["BSDredist"], bsd)]
    marked = lambda text, first, each, last: first + "".join(f"{each}{x}".rstrip() + "\n" for x in text.splitlines()) + last
    forms = [lambda x: x, lambda x: marked(x, "/*\n", " * ", " */\nint main;"), lambda x: marked(x, "", "// ", "\nint x;"), lambda x: marked(x, "#!/bin/sh\n#\n", "# ", "x = 1")]
    rows = [(10 * k + f, form(text)) for k, (_, _, text) in enumerate(want) for f, form in enumerate(forms)]
    rows += [(99, " ".join(gpl.split())), (98, "All rights reserved\nReleased under the MIT License\nA list; licensed under CC BY 4.0")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (name, ids, _) in enumerate(want):
        for f in range(len(forms)):
            r = got[10 * k + f]
            assert (r.licenses, r.sentence_ids, r.n_matched, r.n_unmatched) == ([name], ids, 1, 0)
    assert got[99].sentence_ids == ["GPLfree", "GPLhope"] and got[98].sentence_ids == ["AllRights", "MITref", "CCBYref"]


def plain_score(model, text):
    """The additive model in plain Python: one table entry for each feature and each pair."""
    x = quality_model.text_features(text)
    bins = [sum(e <= v for e in edges) for edges, v in zip(model.edges, x)]
    coarse = [b * 8 // (len(edges) + 1) for b, edges in zip(bins, model.edges)]
    raw = model.intercept + sum(t[b] for t, b in zip(model.tables, bins)) + sum(t[coarse[i]][coarse[j]] for i, j, t in model.pairs)
    return 1 / (1 + math.exp(-raw))


def test_scores_equal_a_plain_model_and_rank_held_out_rows(spark, odd):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_model.train(docs, labels)
    assert len(model.pairs) > 0
    for r in quality_model.score(docs.select("doc_id", "text").union(odd.select("doc_id", "text")), model).collect():
        assert abs(r.score - plain_score(model, r.text)) < 1e-9
    held = quality_model.score(docs, model).filter(quality_model.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97
    strange = odd.selectExpr("*", "'q' as y", "'q' as x", "'q' as h")
    assert quality_model.train(strange, labels).intercept == quality_model.train(odd, labels).intercept


SECRET = [
    (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, lambda v: len(v) >= 6),
    ("AKIA[A-Z0-9]+", 0, lambda v: len(v) >= 20),
    ("[0-9a-f]+", 0, lambda v: len(v) >= 24),
]
MIXED = (r"[A-Za-z0-9+/_=-]+", 0, lambda v: len(v) >= 20 and re.search("[A-Z]", v) and re.search("[a-z]", v) and len(re.findall("[0-9]", v)) > 1)


def redacted(docs):
    """Texts without live secrets, by counting every value's owners and documents."""

    def spans(t):
        base = [(m.start(), m.end(), m[g]) for p, g, ok in SECRET for m in re.finditer(p, t) if ok(m[g])]
        return base, [(m.start(), m.end(), m[0]) for m in re.finditer(MIXED[0], t) if MIXED[2](m[0]) and not any(a < m.end() and b > m.start() for a, b, _ in base)]

    held = {}
    for d, t, owner in docs:
        for _, _, v in sum(spans(t or ""), []):
            held.setdefault(v, []).append((d, owner or ""))
    example = {v for v, x in held.items() if len({o for _, o in x}) >= 5 or (len({o for _, o in x}) >= 2 and len({d for d, _ in x}) >= 20)}
    out = {}
    for d, t, _ in docs:
        text, at = "", 0
        for a, b, v in sorted(sum(spans(t or ""), [])):
            if v not in example:
                text, at = (text + t[at:a] + "[SECRET]" if a >= at else text), max(at, b)
        out[d] = None if t is None else text + t[at:]
    return out


def test_pipeline_equals_brute_force(spark):
    """Each stage on what the stage before kept, in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF).cache()
        held = [(r.doc_id, r.text, r.source) for r in before.collect()]
        if name == "quality":
            model = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {d: t for d, t, _ in held if plain_score(model, t) >= 0.5}
        elif name == "near_duplicates":
            least = components([(d, t) for d, t, _ in held], 5, 80)
            want = {d: t for d, t, _ in held if least[d][1] == d}
        elif name == "decontamination":
            want = {}
            for d, t, _ in held:
                words, hit, _ = brute_hits(t, benchmark)
                if hit <= 0.5 * words:
                    want[d] = t if not hit else None
        elif name == "secrets":
            want = redacted(held)
        else:
            whole = encoder(tokenizer_path()).whole
            ids = {d: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for d, t, _ in held}
            got = sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in after.collect())
            assert got == sorted((d, s, len(x[s : s + 2048]), zlib.crc32(np.array(x[s : s + 2048], "<u4").tobytes()), len(x)) for d, x in ids.items() for s in range(0, len(x), 2048))
            break
        assert after.columns == docs.columns
        got = {r.doc_id: r.text for r in after.collect()}
        assert set(got) == set(want)
        for d, t in want.items():
            if t is not None or name != "decontamination":
                assert got[d] == t
            else:  # what is left has no hit of a whole window that stood there, and all other words in order
                left = iter(decontam.words_of(rows[d].text))
                assert all(w in left for w in decontam.words_of(got[d])) and len(decontam.words_of(got[d])) == len(decontam.words_of(rows[d].text)) - brute_hits(rows[d].text, benchmark)[1]
        assert len(got) > 0
        before = after
    assert name == "packing"


def test_stages_take_odd_and_empty_rows(spark, odd, empty, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    for df in (odd, empty):
        before = df
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, before, str(tmp_path))
            assert after.count() <= 100 * before.count() + 0
            if name != "packing":
                assert after.columns == df.columns
                before = after if name != "quality" else before
    placed = packing.pack(odd, length=64)
    seqs = packing.sequences(placed, length=64).collect()
    assert sum(s.n_tokens for s in seqs) == placed.agg(F.sum("length")).first()[0] and packing.sequences(packing.pack(empty)).count() == 0
    item = spark.createDataFrame([(1, "same text same text")], "item_id long, text string")
    cleaned = {r.doc_id: r.text for r in decontam.clean(odd.withColumn("row", F.lit("q")).withColumn("hits", F.lit("q")), item).collect()}
    assert not {4, 5} & set(cleaned) and cleaned[2] == "" and decontam.clean(empty, item).count() == 0
