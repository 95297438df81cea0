"""Line quality, decontamination, chat formatting, packing and token files against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lodewatch.llm import chat, decontam, packing, quality_rules, token_files, tokens
from lodewatch.llm._common import work_dir
from lodewatch.llm.tokens import encoder, tokenizer_path


def prose(seed, n, vocab=40):
    r = random.Random(seed)
    return "".join(f"w{r.randint(0, vocab)}" + r.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(n))


def repeat_words(words):
    seen, hit = Counter(zip(words, words[1:], words[2:])), set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if seen[w] > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def test_line_quality(spark, odd, empty):
    texts = [prose(s, 10 * s, 4 + s) for s in range(40)] + ["a # b $$ <c> é|", "a\n" * 300]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.line_quality(df).collect()}
    for i, t in enumerate(texts):
        words = t.split()
        lines = [x for x in t.split("\n") if x.split()]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t))
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].n_repeat_words == repeat_words(words)
    assert quality_rules.line_quality(odd).count() == odd.count()
    assert quality_rules.line_quality(empty).count() == 0


def test_boilerplate_lines_and_depleted_documents(spark):
    body = lambda i: " ".join(f"d{i}x{j}" for j in range(60))
    rows = [(i, f"Cookie  NOTICE {'we use ' * 10}\n{body(i)}", "h") for i in range(5)]
    rows += [(9, f"cookie notice {'we use ' * 10}" + "\nfew words " + " ".join(f"z{j}" for j in range(3)), "h"), (10, f"Cookie notice {'we use ' * 10}\n{body(10)}", "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality_rules.line_quality(df, min_docs=4, min_words=5, max_repeat=1.0)
    got = {r.doc_id: r for r in judged.collect()}
    assert got[0].kept and got[0].boilerplate == [0] and got[0].n_line_words == 22
    assert not got[9].kept and got[10].boilerplate is None and got[10].kept
    assert {r.doc_id: r.text for r in quality_rules.clean_text(judged).collect()}[0] == body(0)


def test_boilerplate_of_small_hosts(spark):
    body = lambda h, i: "\n".join(" ".join(f"{h}{i}x{k}y{j}" for j in range(10)) for k in range(6))
    rows = [(100 * n + i, f"All about us\n{body(h, i)}" + ("\nsome have this" if i < 6 else ""), h) for n, (h, size) in enumerate([("a", 40), (None, 10), ("c", 5)]) for i in range(size)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.boilerplate for r in quality_rules.line_quality(df, max_share=0.3).collect()}
    for d, _, h in rows:
        few = h is None and d % 100 < 6
        assert got[d] == (None if h == "c" else [0, 7] if few else [0])


def test_line_counts_of_a_planted_corpus(spark, odd, empty):
    """1,500 documents of six hosts: banners, a page copied under many ids, and a line that one document repeats."""
    r = random.Random(4)
    line = lambda i: " ".join(f"w{r.randint(0, 9999)}" for _ in range(12))
    rows = []
    for i in range(1500):
        host = ["hot", "hot", "hot", "a", "b", None][i % 6]
        parts = [line(i) for _ in range(r.randint(1, 6))]
        if i % 4 == 0:
            parts.insert(0, f"Welcome to  {host} " + "our shop " * 20)
        if i % 30 == 1:
            parts += ["same here " * 3] * 9
        if i % 5 == 2 and host == "hot":
            parts = ["copied page " * 40]
        rows.append((i, "\n".join(parts), host))
    rows += [rows[0]] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = quality_rules.line_quality(df, max_repeat=1.0)
    norm = lambda x: " ".join(x.lower().split())
    docs, size = {}, Counter(h for _, _, h in set(rows))
    for d, t, h in set(rows):
        for k in {norm(x) for x in t.split("\n")} - {""}:
            docs.setdefault((h, k), set()).add(d)
    bad = {k for k, v in docs.items() if len(v) > 5 and len(v) > 0.1 * size[k[0]]}
    want = sorted((d, [n for n, x in enumerate(t.split("\n")) if (h, norm(x)) in bad]) for d, t, h in rows)
    got = judged.collect()
    assert sorted((x.doc_id, x.boilerplate or []) for x in got) == want and sum(bool(p) for _, p in want) > 300
    for x in got:
        lost = sum(len(x.text.split("\n")[n].split()) for n in x.boilerplate or [])
        assert x.n_line_words == lost and x.kept == (not x.base_failed and len(x.text.split()) - lost >= 0.3 * len(x.text.split()))
    assert sum(not x.kept and not x.base_failed for x in got) > 0
    cleaned = quality_rules.clean_text(judged).collect()
    assert len(cleaned) == sum(x.kept for x in got) and not any(("welcome" in x.text.lower()) for x in cleaned)
    assert quality_rules.clean_text(quality_rules.line_quality(odd, min_words=0)).count() == quality_rules.line_quality(odd, min_words=0).filter("kept").count()
    assert quality_rules.clean_text(quality_rules.line_quality(empty)).count() == 0


def test_repeats_in_very_long_texts(spark):
    r = random.Random(2)
    words = [f"v{r.randint(0, 60000)}" for _ in range(70000)] + [f"v{i}" for i in range(10)] * 2
    df = spark.createDataFrame([(1, " ".join(words), "h")], "doc_id long, text string, source string")
    assert quality_rules.line_quality(df).first().n_repeat_words == repeat_words(words)


def brute_hits(text, items, window=10):
    w, hit, which = decontam.words_of(text), set(), set()
    for item, t in items:
        x = decontam.words_of(t)
        k = min(window, len(x))
        grams = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if x else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                which.add(str(item))
    return len(w), len(hit), sorted(which)


@pytest.mark.parametrize("block_words", [100_000, 40])
def test_decontamination(spark, odd, empty, block_words):
    items = [(i, prose(100 + i, 14 + i, 12)) for i in range(12)] + [(50, "w1 W2, w3"), (51, None), (52, "..."), (53, "w7")]
    docs = [(i, prose(i, 300, 12) + (items[i % 12][1] or "") + prose(i + 9, 40, 12)) for i in range(24)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in decontam.find_hits(df, bench, block_words=block_words).collect()}
    for i, t in docs:
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute_hits(t, items)
    if block_words > 1000:
        assert decontam.find_hits(odd, bench).count() == odd.count() and decontam.find_hits(empty, bench).count() == 0
        assert decontam.find_hits(df, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_removed_spans(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    df = spark.createDataFrame([(1, "Before it. " * 8 + "The QUICK, brown fox jumps over the lazy dog again and again! After."), (2, item), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r.text for r in decontam.clean(df, bench).collect()}
    assert out == {1: "Before it. " * 8 + "After.", 3: "clean"}


def test_chat_round_trip(spark, empty):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\/s>", "", " [/INST]</s><s>user[INST] ", "é😀", "<s><s>", "[/INST", "\\\\</s>"]
    turns = [(c, t, ["user", "assistant"][t % 2], nasty[(c + t) % len(nasty)]) for c in range(9) for t in range(c + 1)]
    turns += [(99, t, ["user", "assistant"][t % 2], f"turn {t} {nasty[t % len(nasty)]}") for t in range(300)] + [(50, 0, None, None), (50, 0, None, None), (None, 1, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(df.withColumn("formatted", df.text))
    read = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for c in {t[0] for t in turns}:
        own = [((t[2] or ""), (t[3] or "")) for t in turns if t[0] == c]
        assert [(x.role, x.text) for x in read[c].turns] == own
        assert read[c].loss_text == "".join(x for r, x in own if r == "assistant")
    spans = {r.conv_id: r.spans for r in formatted.collect()}
    assert all(a.end == b.start for x in spans.values() for a, b in zip(x, x[1:]))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_templates_that_rewrite_history():
    def strips(turns):  # earlier assistant turns lose what stands in brackets
        return "".join(f"{r}: {t if k == len(turns) - 1 else t.split(')')[-1]}\n" for k, (r, t) in enumerate(turns))

    plain = [("user", "a"), ("assistant", "b"), ("user", "c")]
    assert chat.render(strips, plain)[2] is None
    assert chat.render(strips, [("user", "a"), ("assistant", "(hm) b"), ("user", "c")])[1:] == (None, 2)
    long = [("user", "a"), ("assistant", "b")] * 80
    out, spans, _ = chat.render(strips, long)
    assert [out[a:b] for a, b, _, _ in spans] == [f"{r}: {t}\n" for r, t in long]
    long[150] = ("user", "(x) y")
    assert chat.render(strips, long)[2] == 151


def test_long_chats_are_rendered_prefix_by_prefix():
    def once(turns):  # the 100th prefix alone has its first turn changed
        return "".join(f"{r}: {'!' if len(turns) == 100 and k == 0 else t}\n" for k, (r, t) in enumerate(turns))

    def strict(turns):
        if any(r != ["user", "assistant"][k % 2] for k, (r, _) in enumerate(turns)):
            raise ValueError("roles must alternate")
        return "".join(f"{r}: {t}\n" for r, t in turns)

    def thinks(turns):  # history changes if a tool answers in a chat that a system turn opened
        think = turns and turns[0][0] == "system" and turns[-1][0] == "tool"
        return ("[think]" if think else "") + "".join(f"{r}: {t}\n" for r, t in turns)

    turns = [("user", "a"), ("assistant", "b")] * 80
    assert chat.render(once, turns)[1:] == (None, 99)
    out, spans, at = chat.render(strict, turns)
    assert at is None and [out[a:b] for a, b, _, _ in spans] == [f"{r}: {t}\n" for r, t in turns] and [out[x:y] for _, _, x, y in spans] == [t for _, t in turns]
    tools = [("system", "s"), *turns[:70], ("tool", "t"), *turns[:29]]
    assert chat.render(thinks, tools)[2] == 71


def test_texts_that_hold_markers_or_are_hidden():
    marks = "\ue000\ue001\uf8ff"
    turns = [("user", marks), ("assistant", f"say {marks}"), ("user", " b ")]
    out, spans, _ = chat.render(chat.instruct_template, turns)
    assert [chat.unescape(out[x:y]) for _, _, x, y in spans] == [t for _, t in turns]
    trims = lambda turns: "".join(f"{r}: {t.strip()}\n" for r, t in turns)
    out, spans, _ = chat.render(trims, turns)
    assert [out[x:y] for _, _, x, y in spans] == [t.strip() for _, t in turns]
    drops = lambda turns: "".join(f"{r}: {t if r == 'user' else ''}\n" for r, t in turns)
    out, spans, at = chat.render(drops, turns)
    assert at is None and [out[x:y] for _, _, x, y in spans] == [marks, "", " b "]


def test_rows_without_a_conversation_stand_alone(spark):
    df = spark.createDataFrame([(None, k, "user", f"t{k}") for k in range(20)] + [(None, 0, "user", "t0")], "conv_id long, turn long, role string, text string")
    assert sorted(x.loss_text + x.turns[0].text for x in chat.read_back(chat.format_chats(df)).collect()) == sorted([f"t{k}" for k in range(20)] + ["t0"])


def test_encoder_equals_library():
    enc = encoder(tokenizer_path())
    texts = [prose(s, 50) for s in range(5)] + ["Don't  STOP!! <|endoftext|>x été\tİ ﬁ ΣΣς 123", "", "\n", "日本語", "a" * 3000, "Å̊ é É", "the, the. The;", "word\x1cword", "$$$the&&& 'sword it's' (o'clock') |x| <|x|> <|startoftext|> a_b_ <b>the</b> --the-- é'"]
    assert [np.frombuffer(x, enc.kind).tolist() for x in enc.encode(texts)] == [e.ids for e in enc.whole.encode_batch(texts, add_special_tokens=False)]


def test_encoder_on_random_unicode_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 300)
    enc, r = tokens.Encoder(tokenizer_path()), random.Random(1)
    pool = ["a", "B", "é", "É", "ß", "Ÿ", "÷", "×", "'", "'s", "'re", "<|", "|>", "<|endoftext|>", " ", "\n", "\t", "1", "99", "ﬁ", "日", "😀", "\u0301", "İ", "Σ", "-", "_", ".", "!!", "\u00a0", "\x85", "\x00", "\u212a", "ª", "the", "ing", "~", "\r", "x" * 70, "ab" * 40]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 60))) for _ in range(800)]
    texts += ["".join(chr(r.choice([r.randint(0, 0x250), r.randint(0, 0x2FFF), r.randint(0xE000, 0x1FFFF)])) for _ in range(30)) for _ in range(400)]
    texts += [prose(s, 300, 400) for s in range(20)]
    for i in range(0, len(texts), 50):
        part = texts[i : i + 50]
        assert [x.tolist() for x in enc.encode(part)] == [e.ids for e in enc.whole.encode_batch(part, add_special_tokens=False)]
    assert 0 < len(enc.words.met) <= 300 + 2000


def test_token_files(spark, odd, empty):
    path = token_files.write_token_files(odd, work_dir(spark, "t"), block_bytes=2000)
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    whole = encoder(tokenizer_path()).whole
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in odd.collect()], key=lambda x: -1 if x is None else x)
    at = 0
    by_id = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in rows:
        want = np.array([*whole.encode(by_id[r.doc_id], add_special_tokens=False).ids, 1], "<u4")
        assert r.start == at and bytes(r.ids) == want.tobytes() and r.n_tokens == len(want)
        at += r.n_tokens
    assert len(token_files.read_document(spark, path, 4)) == 2 and len(token_files.read_document(spark, path, 77)) == 0
    assert token_files.read_token_files(spark, token_files.write_token_files(empty, work_dir(spark, "t"))).count() == 0


def test_packing(spark, odd, empty):
    docs = spark.createDataFrame([(i, prose(i, 7 * i)) for i in range(150)], "doc_id long, text string")
    df = docs.unionByName(odd.select("doc_id", "text"))
    placed = packing.pack(df, length=256).cache()
    rows = placed.collect()
    whole = encoder(tokenizer_path()).whole
    want = Counter((r.doc_id, len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in df.collect())
    got, pieces = Counter(), Counter()
    own = [[*whole.encode(r.text or "", add_special_tokens=False).ids, 1] for r in df.collect()]
    cuts = Counter((r.doc_id, s, np.array(x[s : s + 256], "<u4").tobytes()) for r, x in zip(df.collect(), own) for s in range(0, len(x), 256))
    for r in rows:
        pieces[r.doc_id, r.start, bytes(r.ids)] += 1
        got[r.doc_id, r.doc_tokens] += r.length
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert got == {k: n * k[1] for k, n in want.items()} and pieces == cuts
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 256
    total = sum(r.length for r in rows)
    assert len(by) * 256 < 1.05 * total + 512
    seqs = packing.sequences(placed, length=256).collect()
    assert all(len(s.ids) in (1024, 4 * s.n_tokens) for s in seqs) and sum(s.n_tokens for s in seqs) == total
    assert packing.pack(empty).count() == 0


def test_cutting_stock_is_near_its_bound():
    r = np.random.default_rng(3)
    demand = np.zeros(65, np.int64)
    np.add.at(demand, np.clip(r.lognormal(2.5, 1, 4000).astype(int), 1, 64), 1)
    uses = packing.cutting_stock(demand, 64)
    got = np.zeros(65, np.int64)
    for copies, n in uses:
        assert sum(c * a for c, a in copies.items()) <= 64
        for c, a in copies.items():
            got[c] += a * n
    assert (got == demand).all()
    assert sum(n for _, n in uses) <= 1.01 * (demand * np.arange(65)).sum() / 64 + 1


@pytest.mark.parametrize("shortest,longest", [(1, 1), (9, 9), (1, 39), (65, 65), (1, 2047)])
def test_padding_of_any_lengths_is_little(shortest, longest):
    lens = np.exp(np.random.default_rng(7).uniform(np.log(shortest), np.log(longest + 1), 100_000)).astype(int)
    demand, classes = np.zeros(2049, np.int64), packing.class_lengths(2048)[1]
    np.add.at(demand, classes[np.searchsorted(classes, lens)], 1)
    uses = packing.cutting_stock(demand, 2048)
    assert all(sum(c * a for c, a in copies.items()) <= 2048 for copies, _ in uses)
    assert lens.sum() / (2048 * sum(n for _, n in uses)) >= 0.98


def test_odd_pieces_have_places(spark):
    """A third of all rows is one row without an id; full pieces and extra columns that clash."""
    rows = [(None, 0, 9, "a")] * 400 + [(i, 0, 2048, "b") for i in range(300)] + [(i, 2048, 1 + i, "b") for i in range(300)]
    pieces = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, start long, length long, `offset` string, piece_id long")
    got = packing.place(pieces.withColumn("_class", packing.F.lit("z"))).collect()
    assert Counter((r.doc_id, r.start, r.length) for r in got) == Counter(r[:3] for r in rows)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), [*sorted(parts)[1:], (sum(n for _, n in parts), 0)]))
