"""Benchmark decontamination with a generalised suffix automaton of the benchmark's words.

Words are runs of digits, lower-cased ASCII letters and non-ASCII characters. Training words are streamed through
the automaton, which keeps the longest match that ends at each word; a match of ``window`` words (or of a whole
shorter item) hits the words it covers. A table of the benchmark's word pairs skips stretches that cannot hold a match.

The benchmark is the stated query set. It passes through the driver in blocks of at most ``block_words`` words, one
automaton a block, so what is sent to the executors has a fixed bound; with several blocks the documents are read
once for each, and of all but the last pass only the hits of documents that have any are kept, and joined at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text, slices
from lodewatch.operators.sized import maybe_broadcast

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same words in a text, for their character positions.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_SLOTS = 1 << 22


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class SuffixAutomaton:
    """All substrings of the items' word sequences, each state with the items that hold its ``window``-word suffix."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window, self.ids = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]) for item, words in items if words]
        last_of = []
        for _, words in coded:
            v, path = 0, []
            for c in words:
                v = self._extend(v, c)
                path.append(v)
            last_of.append(path)
        n = len(self.next)
        self.items: list[set] = [set() for _ in range(n)]
        at_end: dict[int, list] = {}
        for item, words in coded:
            v = 0
            for c in words:  # the states of the item's prefixes, and above them those of their suffixes
                v = u = self.next[v][c]
                while u > 0 and self.length[u] >= window and item not in self.items[u]:
                    self.items[u].add(item)
                    u = self.link[u]
            if len(words) < window:
                at_end.setdefault(v, []).append((len(words), item))
        order = sorted(range(1, n), key=self.length.__getitem__)
        self.anchor, self.short = [0] * n, [()] * n
        for v in order:
            up = self.link[v]
            if self.length[v] >= window:
                self.anchor[v] = v if self.length[up] < window else self.anchor[up]
            self.short[v] = (*at_end.get(v, ()), *self.short[up])
        self.least = min([window, *(len(w) for _, w in coded)])
        self.pairs = np.zeros(_SLOTS, bool)
        for _, words in coded:
            x = np.array(words, np.int64)
            self.pairs[self._slot(x[:-1], x[1:])] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 2654435761 + b * 40503) & (_SLOTS - 1)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            new = len(nxt)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = new
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = new
                p = link[p]
            return new

        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else split(last, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def stretches(self, ids: np.ndarray) -> np.ndarray:
        """(from, to) of the stretches long enough to hold a match whose neighbouring words all stand together in some item."""
        if self.least > 1:
            good = (ids[:-1] > 0) & (ids[1:] > 0)
            if not good.any():
                return np.empty((0, 2), np.int64)
            good &= self.pairs[self._slot(ids[:-1], ids[1:])]
        else:
            good = ids > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], good.view(np.int8), [0]])))
        spans = edges.reshape(-1, 2)
        spans = spans[spans[:, 1] - spans[:, 0] >= max(1, self.least - 1)]
        return spans + [0, 1] if self.least > 1 else spans

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (from, to) in words, apart from one another and in order, and the items that hit."""
        n = len(words)
        if n < self.least or not self.ids:
            return [], set()
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, n)
        spans: list[list[int]] = []
        items: set = set()
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in self.stretches(ids).tolist():
            v = matched = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while v and c not in nxt[v]:
                    v = link[v]
                    matched = length[v]
                if c not in nxt[v]:
                    continue
                v = nxt[v][c]
                matched += 1
                lo = i + 1
                if matched >= window:
                    lo = i + 1 - window
                    items |= self.items[self.anchor[v]]
                for k, item in self.short[v]:
                    if k <= matched:
                        lo = min(lo, i + 1 - k)
                        items.add(item)
                if lo <= i:
                    while spans and lo <= spans[-1][1]:
                        lo = min(lo, spans.pop()[0])
                    spans.append([lo, i + 1])
        return [tuple(x) for x in spans], items


_automata: dict[tuple, SuffixAutomaton] = {}


def _automaton(key: str, items: list, window: int) -> SuffixAutomaton:
    if (key, window) not in _automata:
        _automata.clear()
        _automata[key, window] = SuffixAutomaton(items, window)
    return _automata[key, window]


def item_blocks(benchmark: DataFrame, *, window: int, block_words: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[str, list[bytes]]]]:
    """Lists of (item id as text, words) of at most ``block_words`` words; a longer item is cut with an overlap that keeps every window."""
    block, held = [], 0
    for r in benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).toLocalIterator():
        words = words_of(r.text)
        for s in range(0, max(1, len(words) - window + 1), block_words - window + 1):
            part = words[s : s + block_words]
            if not part:
                continue
            if block and held + len(part) > block_words:
                yield block
                block, held = [], 0
            block.append((r.item if r.item is not None else "", part))
            held += len(part)
    if block:
        yield block


def find_hits(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block_words: int = 100_000, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, edit: tuple[float, int] | None = None) -> DataFrame:
    """doc_id, text, n_words, hits (array of (from, to) in words, apart and in order), n_hit, items (sorted as strings).

    Columns named in ``carry`` come along in a struct named row. With ``edit`` (coverage limit, least span) the last pass also
    leaves out documents hit beyond the limit and takes hit spans of that many words or more out of the others' texts.

    A null or empty text has no words; an empty benchmark hits nothing; repeated rows are each looked at, and a null
    item id counts as ''. Every window of every item is looked for in every whole text; nothing is sampled.
    """
    rows = id_text(docs.withColumn("row", F.struct(*(f"`{c}`" for c in carry))), id_col, text_col, row="row") if carry else id_text(docs, id_col, text_col)
    kinds = dict(rows.dtypes)
    schema = f"doc_id {kinds['doc_id']}, text string, n_words long, hits array<struct<`from`:int,`to`:int>>, n_hit long, items array<string>" + (f", row {kinds['row']}" if carry else "")
    rows = rows.withColumn("same", F.xxhash64("text"))
    last, found = None, []
    for items in item_blocks(benchmark, window=window, block_words=block_words):
        if last is not None:
            hit = rows.select("doc_id", "text", "same").mapInArrow(_scanner(last, window, only_hits=True), f"{schema.replace('text string, ', '').split(', row')[0]}, same long")
            found.append(cut(hit.select("doc_id", "same", "hits", "items").dropDuplicates(["doc_id", "same"]), "hits"))
        last = items
    if found:
        every = reduce(DataFrame.unionByName, found).groupBy("doc_id", "same").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        before = cut(every.select(F.col("doc_id").alias("d"), F.col("same").alias("s"), "hits", "items"), "hits")
        rows = rows.join(maybe_broadcast(before), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("same") == F.col("s")), "left").drop("d", "s")
    return rows.drop("same").mapInArrow(_scanner(last or [], window, edit), schema)


def _scanner(items: list[tuple[str, list[bytes]]], window: int, edit: tuple[float, int] | None = None, only_hits: bool = False):
    import hashlib

    key = hashlib.sha256(repr(items).encode()).hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sam = _automaton(key, items, window)
        pair = pa.struct([("from", pa.int32()), ("to", pa.int32())])
        for batch in slices(batches):
            had = batch.column("hits").to_pylist() if "hits" in batch.schema.names else repeat([])
            had_items = batch.column("items").to_pylist() if "items" in batch.schema.names else repeat([])
            counts, hits, sums, found = [], [], [], []
            for text, old, old_items in zip(batch.column("text").to_pylist(), had, had_items):  # noqa: B905
                words = words_of(text)
                spans, which = sam.scan(words)
                if old:
                    spans = merged([*spans, *((x["from"], x["to"]) for x in old)])
                    which = which.union(old_items)
                counts.append(len(words))
                hits.append([{"from": a, "to": b} for a, b in spans])
                sums.append(sum(b - a for a, b in spans))
                found.append(sorted(which))
            if only_hits:
                out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pair)), pa.array(sums, pa.int64()), pa.array(found, pa.list_(pa.string())), batch.column("same")], ["doc_id", "n_words", "hits", "n_hit", "items", "same"])
                yield out.filter(pa.array([bool(x) for x in hits], pa.bool_()))
                continue
            more = ["row"] if "row" in batch.schema.names else []
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pair)), pa.array(sums, pa.int64()), pa.array(found, pa.list_(pa.string())), *map(batch.column, more)], ["doc_id", "text", "n_words", "hits", "n_hit", "items", *more])
            yield _edited(out, *edit) if edit else out

    return scan


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span (and the blanks after it)."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
        while last < len(text) and text[last] in " .,;:!?":
            last += 1
    return "".join([*out, text[last:]])


def _edited(batch: pa.RecordBatch, max_coverage: float, min_span: int) -> pa.RecordBatch:
    n_words, n_hit = batch.column("n_words").to_numpy(), batch.column("n_hit").to_numpy()
    batch = batch.filter(pa.array(n_hit <= max_coverage * n_words))
    texts = [without_words(t, [(x["from"], x["to"]) for x in h if x["to"] - x["from"] >= min_span]) if h else t for t, h in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist(), strict=True)]
    return batch.set_column(1, "text", pa.array(texts, pa.string()))


def clean(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, max_coverage: float = 0.5, min_span: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all their columns, without the spans hit; a document hit for more than ``max_coverage`` of its words goes.

    A document without hits is left as it is; a null text becomes empty.
    """
    others = [c for c in docs.columns if c != text_col]
    kept = find_hits(docs, benchmark, window=window, id_col=id_col, text_col=text_col, carry=others, edit=(max_coverage, min_span))
    return kept.select(*(F.col("text").alias(text_col) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))
