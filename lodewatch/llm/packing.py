"""Packing token sequences as a cutting-stock problem solved by column generation.

Documents are cut into full sequences and one remainder each. A full piece is a sequence by itself. The others are
counted by classes of length (exact for short lengths, up to 8 tokens wide for long ones), so the program's size is
fixed, however large the corpus. A linear program over patterns (multisets of classes that fit a sequence) is solved by
revised simplex; a knapsack dynamic program prices new patterns. Its counts are rounded down, what is left is packed
best-fit, and documents are assigned by their rank inside their class. Only the histogram and the patterns, both of
bounded size, are on the driver.
"""

from __future__ import annotations

import math
import warnings
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text, slices
from lodewatch.llm.tokens import encode_rows, tokenizer_path

#: Least number of groups in which a class's pieces are ranked, and most pieces that such a group is meant for.
_SALTS, _RANKED = 128, 250_000


def class_lengths(length: int) -> tuple[int, np.ndarray]:
    """(unit, the longest lengths of the classes): a class is as wide as its unit beyond an eighth of ``length``, the shorter ones ever finer."""
    unit, upto = max(1, length // 256), [0]
    while upto[-1] < length:
        width = next((w for w in (1, 2, 4) if w < unit and upto[-1] < 8 * unit * w), unit)
        upto.append(min(length, upto[-1] + width))
    return unit, np.array(upto[1:])


def knapsack_items(sizes: np.ndarray, capacity: int, unit: int) -> np.ndarray:
    """Rows (class, copies, room in units), by room: as many copies of a size as take whole units together, and fewer in what they need at least."""
    items = [(k, n, -(-n * c // unit)) for k, c in enumerate(sizes.tolist()) for n in range(1, unit // math.gcd(c, unit) + 1) if n * c <= capacity // unit * unit]
    return np.array(sorted(items, key=lambda x: x[2])).reshape(-1, 3)


def best_pattern(value: np.ndarray, items: np.ndarray, rooms: int) -> np.ndarray:
    """Unbounded knapsack: the copies of each class, worth ``value`` apiece, of the best multiset of ``items`` that fits ``rooms`` units."""
    kind, copies, size = items.T
    worth = value[kind] * copies
    fitting = np.searchsorted(size, np.arange(rooms + 1), side="right").tolist()
    best, pick = np.zeros(rooms + 1), np.full(rooms + 1, -1)
    for room in range(1, rooms + 1):
        best[room] = best[room - 1]
        if n := fitting[room]:
            got = worth[:n] + best[room - size[:n]]
            k = int(got.argmax())
            if got[k] > best[room] + 1e-12:
                best[room], pick[room] = got[k], k
    pattern, room = np.zeros(len(value)), rooms
    while room > 0:
        if (k := pick[room]) >= 0:
            pattern[kind[k]] += copies[k]
            room -= int(size[k])
        else:
            room -= 1
    return pattern


def cutting_stock(demand: np.ndarray, capacity: int, max_rounds: int = 4000) -> list[tuple[dict[int, int], int]]:
    """Patterns ({size: copies}, uses) that hold ``demand[n]`` pieces of each size n in 1..capacity.

    The linear program's optimum is approached until the bound by Farley is within half a sequence or a
    200th part; uses are rounded down and the remaining pieces (a few for each pattern) packed best-fit. Should
    ``max_rounds`` steps not be enough, a warning tells it; the pieces are packed all the same.
    """
    sizes, unit = np.flatnonzero(demand), class_lengths(capacity)[0]
    uses: list[tuple[dict[int, int], int]] = []
    left = demand.astype(np.int64).copy()
    if len(sizes):
        # Sums of products stand for matrix products: a threaded BLAS stalls beside busy executors on one machine.
        m, need, items = len(sizes), demand[sizes].astype(float), knapsack_items(sizes, capacity, unit)
        fill = (capacity // sizes).astype(float)
        basis, inverse, x = np.diag(fill), np.diag(1 / fill), need / fill
        cost, dual = np.ones(m), 1 / fill
        # Prices swing widely from basis to basis; patterns are sought near those of the best bound so far (at first, shares of a sequence).
        center, bound = sizes / capacity, (need * sizes).sum() / capacity
        for _ in range(max_rounds):
            if dual[low := int(dual.argmin())] < -1e-9:  # more of a class than asked for
                column, price, gain = np.zeros(m), 0.0, dual[low]
                column[low] = -1.0
            else:
                if (now := (cost * x).sum()) - bound < max(0.5, 5e-3 * now):
                    break
                for near in (0.8, 0.0):
                    trial = near * center + (1 - near) * dual
                    column = best_pattern(trial, items, capacity // unit)
                    if (least := (trial * need).sum() / max((column * trial).sum(), 1.0)) > bound:
                        center, bound = trial, least
                    if (column * dual).sum() > 1 + 1e-7:
                        break
                else:
                    break
                price, gain = 1.0, 1 - (column * dual).sum()
            some = np.flatnonzero(column)
            move = (inverse[:, some] * column[some]).sum(1)
            ratio = np.where(move > 1e-9, np.maximum(x, 0) / np.where(move > 1e-9, move, 1), np.inf)
            out = int(ratio.argmin())
            step, row = ratio[out], inverse[out] / move[out]
            basis[:, out], cost[out] = column, price
            dual = dual + gain * row
            x -= step * move
            x[out] = step
            inverse -= move[:, None] * row
            inverse[out] = row
        else:
            warnings.warn(f"no optimum after {max_rounds} steps; sequences may have more padding", stacklevel=2)
        for k in range(m):
            n = int(np.floor(x[k] + 1e-6))
            if cost[k] and n > 0:
                copies = {int(sizes[i]): int(basis[i, k]) for i in np.flatnonzero(basis[:, k] > 0.5)}
                n = min(n, *(max(0, int(left[c])) // a for c, a in copies.items()))
                if n:
                    uses.append((copies, n))
                    for c, a in copies.items():
                        left[c] -= a * n
    open_: list[Counter] = []
    rooms: list[tuple[int, int]] = []  # (free tokens, which), in order
    for c in range(capacity, 0, -1):
        n = int(left[c])
        while n:
            at = bisect_left(rooms, (c, 0))
            if at < len(rooms):
                room, k = rooms.pop(at)
            else:
                room, k = capacity, len(open_)
                open_.append(Counter())
            put = min(n, room // c)
            open_[k][c] += put
            n -= put
            insort(rooms, (room - put * c, k))
    same = Counter(tuple(sorted(x.items())) for x in open_)
    return uses + [(dict(k), n) for k, n in same.items()]


def cut_documents(docs: DataFrame, *, length: int = 2048, tokenizer: str | None = None, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of whole documents: doc_id, start, length, doc_tokens, ids (binary, little-endian unsigned 32-bit), ids_crc32.

    A null text is empty, so its document is its end id alone; with ``end_id=None`` such a document has no piece.
    Repeated rows are cut each on their own; ``piece_id`` is a row's own. The pieces are a table in the shared folder.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = id_text(docs, id_col, text_col)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, starts, lengths, wholes, parts = [], [], [], [], []
            for k, x in enumerate(encode_rows(batch.column("text").to_pylist(), tokenizer, end_id)):
                raw = x.astype("<u4").tobytes()
                for s in range(0, len(x), length):
                    n = min(length, len(x) - s)
                    rows.append(k)
                    starts.append(s)
                    lengths.append(n)
                    wholes.append(len(x))
                    parts.append(raw[4 * s : 4 * (s + n)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(wholes, pa.int64()), pa.array(parts, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    made = rows.mapInArrow(pieces, f"doc_id {dict(rows.dtypes)['doc_id']}, start long, length long, doc_tokens long, ids binary")
    return cut(made.withColumns({"ids_crc32": F.crc32("ids"), "piece_id": F.monotonically_increasing_id()}), "pieces")


def place(pieces: DataFrame, *, length: int = 2048) -> DataFrame:
    """Adds sequence_id and offset (gapless from 0 in each sequence) to pieces of 1..``length`` tokens.

    ``pieces`` has doc_id, start, length and piece_id (of a row alone); its other columns are kept, but columns named
    sequence_id, offset or ``_*`` are dropped. It is read several times, so it should be a table. Null and repeated
    ids are told apart by piece_id; an empty table gives an empty one.
    """
    spark, pieces = pieces.sparkSession, pieces.select(*(f"`{c}`" for c in pieces.columns if c not in ("sequence_id", "offset") and not c.startswith("_")))
    demand = np.zeros(length + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``length`` rows
        demand[r.length] = r["count"]
    n_full, demand[length] = int(demand[length]), 0
    longest = class_lengths(length)[1]
    class_of = longest[np.searchsorted(longest, np.arange(1, length + 1))].tolist()
    by_class = np.zeros(length + 1, np.int64)
    np.add.at(by_class, class_of, demand[1:])
    # A class's pieces are ranked inside salts, whose counts are then added up: no class is one task's. Salts grow with the class.
    salts = lambda pieces: max(_SALTS, -(-int(pieces) // _RANKED))
    classed = [(n, c, salts(by_class[c])) for n, c in enumerate(class_of, 1) if n < length] + [(length, length + 1, salts(n_full))]
    lengths = spark.createDataFrame(classed, "length long, _class int, _salts int")
    rows = pieces.join(F.broadcast(lengths), "length").withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start", "piece_id"), F.col("_salts")).cast("int")).drop("_salts")
    before, seen = [], Counter()
    for r in sorted(rows.groupBy("_class", "_salt").count().collect(), key=lambda r: (r._class, r._salt)):
        before.append((r._class, r._salt, seen[r._class]))
        seen[r._class] += r["count"]
    spans, taken, sequence = [(length + 1, 0, n_full, 1, 0)], Counter(), n_full
    for copies, n in cutting_stock(by_class, length):
        for c, a in copies.items():
            spans.append((c, taken[c], taken[c] + a * n, a, sequence))
            taken[c] += a * n
        sequence += n
    before_ = spark.createDataFrame(before, "_class int, _salt int, _before long")
    spans_ = spark.createDataFrame(spans, "_class2 int, _from long, _to long, _copies int, _first long")
    inside = Window.partitionBy("_class", "_salt").orderBy("doc_id", "start", "piece_id")
    ranked = rows.withColumn("_row", F.row_number().over(inside)).join(F.broadcast(before_), ["_class", "_salt"]).withColumn("_rank", F.col("_row") + F.col("_before") - 1)
    put = ranked.join(F.broadcast(spans_), F.expr("_class = _class2 and _rank >= _from and _rank < _to")).withColumn("sequence_id", F.expr("_first + (_rank - _from) div _copies"))
    along = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = put.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)))
    return placed.select(*(f"`{c}`" for c in pieces.columns), "sequence_id", "offset")


def sequences(placed: DataFrame, *, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (binary, padded to ``length`` except at a power of two), doc_ids, starts.

    ``placed`` has ids. A sequence holds at most ``length`` tokens, so its group is small.
    """
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    power = (F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1)) == 0
    pad = F.when(power, F.lit(0)).otherwise(F.lit(length) - F.col("n_tokens"))
    ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    padding = F.unhex(F.repeat(F.lit(np.array([pad_id], "<u4").tobytes().hex()), pad.cast("int")))
    return parts.select("sequence_id", "n_tokens", F.concat(ids, padding).alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"))


def pack(docs: DataFrame, *, length: int = 2048, **kind) -> DataFrame:
    """``cut_documents`` and ``place``: every piece of every document with its ids and its place in a sequence."""
    return place(cut_documents(docs, length=length, **kind), length=length)
