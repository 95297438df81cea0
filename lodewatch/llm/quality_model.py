"""Quality classifier: a generalised additive model with pairwise interactions.

Per-feature lookup tables are learned by cyclic boosting of shallow trees over the features' bins, one feature after
the other in small steps; then tables over pairs of features on what is left. A score is the sum of one table entry
for each feature and pair, so scoring is a few vectorised additions a document. Features come from the text alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import id_text, slices

FEATURES = (
    "log_words", "mean_word", "long_words", "short_words", "upper", "digits", "symbols", "bars", "marks", "stops",
    "commas", "new_words", "new_pairs", "top_word", "new_lines", "log_line_words", "lone_signs",
)
_BYTES = np.arange(256)


def _set(chars: bytes) -> np.ndarray:
    return np.isin(_BYTES, np.frombuffer(chars, np.uint8))


_UPPER, _DIGIT, _SYMBOL = _set(bytes(range(65, 91))), _set(bytes(range(48, 58))), _set(b"#*$%&<>=@^~\\{}[]_+/")
_BAR, _MARK, _STOP, _COMMA = _set(b"|"), _set(b"!?"), _set(b"."), _set(b",;:")


def text_features(text: str | None) -> list[float]:
    """The text's features; an empty text has all at 0. Whole texts are looked at."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    sizes = np.fromiter(map(len, words), np.int64, n)
    chars = int(sizes.sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kinds = Counter(words)
    pairs = len(set(zip(words, words[1:])))  # noqa: B905
    signs = kinds[b"|"] + kinds[b"-"] + kinds[b"*"] + kinds[b"#"]
    share = lambda which, k=chars: float(of[which].sum()) / k
    return [
        np.log1p(n), chars / n, float((sizes > 14).mean()), float((sizes <= 3).mean()), share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_BAR), share(_MARK, n), share(_STOP, n),
        share(_COMMA, n), len(kinds) / n ** 0.8, pairs / max(1, n - 1), max(kinds.values()) / n, len(set(lines)) / len(lines), np.log1p(n / len(lines)), signs / n,
    ]


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray, least: float, ridge: float = 1.0) -> np.ndarray:
    """Leaf values by bin of the best tree of at most three leaves (two cuts) on ordered bins."""

    def best_cut(a: int, b: int) -> tuple[float, int]:
        g, h, c = grad[a:b].cumsum(), hess[a:b].cumsum(), count[a:b].cumsum()
        if b - a < 2:
            return 0.0, a
        gain = g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge) - g[-1] ** 2 / (h[-1] + ridge)
        gain = np.where((c[:-1] >= least) & (c[-1] - c[:-1] >= least), gain, 0)
        k = int(gain.argmax())
        return float(gain[k]), a + k + 1

    n = len(grad)
    out = np.zeros(n)
    gain, cut = best_cut(0, n)
    if gain <= 1e-9:
        return out
    (left, x), (right, y) = best_cut(0, cut), best_cut(cut, n)
    cuts = [0, cut, n] if max(left, right) <= 1e-9 else sorted([0, cut, n, x if left > right else y])
    for a, b in zip(cuts, cuts[1:]):  # noqa: B905
        out[a:b] = -grad[a:b].sum() / (hess[a:b].sum() + ridge)
    return out


@dataclass
class AdditiveModel:
    """``intercept`` plus a table for each feature plus a table for each pair of features."""

    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]

    def coarse(self, bins: np.ndarray, k: int, n: int = 8) -> np.ndarray:
        return bins * n // (len(self.edges[k]) + 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        out = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, bins, strict=True):
            out += table[b]
        for i, j, table in self.pairs:
            out += table[self.coarse(bins[i], i), self.coarse(bins[j], j)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, *, max_bins: int = 48, rounds: int = 200, rate: float = 0.1, max_pairs: int = 6, pair_rounds: int = 60) -> AdditiveModel:
    """Fits the model to rows ``x`` with labels ``y`` in {0, 1}; with one class or no rows only the intercept is learned."""
    model = AdditiveModel(edges=[np.unique(np.quantile(x[:, k], np.linspace(0, 1, max_bins + 1)[1:-1])) if len(x) else np.empty(0) for k in range(len(FEATURES))])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    share = (y.sum() + 1) / (len(y) + 2)
    model.intercept = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return model
    bins, f = model.bins(x), np.full(len(y), model.intercept)
    least = max(3.0, len(y) / 500)
    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k, b in enumerate(bins):
            g, h = gradients()
            step = rate * _shallow_tree(np.bincount(b, g, len(model.tables[k])), np.bincount(b, h, len(model.tables[k])), counts[k], least)
            model.tables[k] += step
            f += step[b]
    # Pairs whose best four quadrants explain most of what is left.
    g, h = gradients()
    coarse = [model.coarse(b, k) for k, b in enumerate(bins)]

    def quadrants(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        cell = coarse[i] * 8 + coarse[j]
        gs, hs, cs = (np.bincount(cell, v, 64).reshape(8, 8).cumsum(0).cumsum(1) for v in (g, h, np.ones(len(g))))
        best, value = 0.0, np.zeros((8, 8))
        for a in range(7):
            for b in range(7):
                part = lambda s, a=a, b=b: np.array([s[a, b], s[a, 7] - s[a, b], s[7, b] - s[a, b], s[7, 7] - s[a, 7] - s[7, b] + s[a, b]])
                if part(cs).min() < least:
                    continue
                gq, hq = part(gs), part(hs)
                gain = float((gq**2 / (hq + 1)).sum() - gs[7, 7] ** 2 / (hs[7, 7] + 1))
                if gain > best:
                    leaf = -gq / (hq + 1)
                    best, value = gain, np.zeros((8, 8))
                    value[: a + 1, : b + 1], value[: a + 1, b + 1 :], value[a + 1 :, : b + 1], value[a + 1 :, b + 1 :] = leaf
        return best, value

    gains = sorted(((quadrants(i, j, g, h)[0], i, j) for i in range(len(FEATURES)) for j in range(i)), reverse=True)[:max_pairs]
    tables = {(i, j): np.zeros((8, 8)) for gain, i, j in gains if gain > 1e-6}
    for _ in range(pair_rounds):
        for (i, j), table in tables.items():
            gain, step = quadrants(i, j, *gradients())
            if gain > 1e-6:
                table += rate * step
                f += rate * step[coarse[i], coarse[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def held_out(doc_id) -> F.Column:
    """Whether crc32(id as text) mod 3 is 1; a row without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, max_rows: int = 6000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AdditiveModel:
    """Fits the model to at most ``max_rows`` labelled documents outside the held-out third.

    The sample is bounded by that parameter: the rows whose hashed ids are smallest. Only their features (17 numbers
    each) come to the driver. Repeated labels of one id count as one, the larger wins; null labels or ids are left out.
    """
    key = F.col(f"`{id_col}`").alias("doc_id")
    wanted = labels.select(key, F.col(f"`{label_col}`").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = id_text(docs, id_col, text_col).join(F.broadcast(wanted), "doc_id").select("doc_id", "text", F.col("y").cast("double").alias("y"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([text_features(t) for t in b.column("text").to_pylist()], pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    got = sorted((r.doc_id, r.y, tuple(r.x)) for r in rows.mapInArrow(features, f"doc_id {dict(rows.dtypes)['doc_id']}, y double, x array<double>").collect())
    x = np.array([r[2] for r in got]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r[1] for r in got]))


def score(docs: DataFrame, model: AdditiveModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, score (0 to 1) of every row; a null or empty text is scored like a text without words."""
    rows = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.array([text_features(t) for t in b.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(model.score(x))], ["doc_id", "text", "score"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string, score double")


def keep(docs: DataFrame, model: AdditiveModel, *, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.array([text_features(t) for t in b.column(text_col).to_pylist()]).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
