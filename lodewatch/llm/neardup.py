"""Near-duplicates by SetSketch: exponentially spaced registers, banded, judged by joint likelihood, verified on full sets.

A register holds the truncated exponent of the least of a set's exponential variables, so it is mergeable (by maximum)
and two sets share it about as often as they share elements. Texts with equal shingle sets are one class from the start.
Classes that agree on a whole band meet in its bucket. A bucket is never expanded into pairs. First every class is
verified against the least class it meets. Then parts that still meet, through classes of some likeness, form families;
in a family each class outside its largest part is compared with every class of another part, in blocks that ship a
set once: by registers, and where those leave a chance, on the full sets. Last, a bucket's members outside the family
of its least class are compared with all its members of another family. Only links that join parts are emitted.

With ``_BANDS`` bands of ``_ROWS`` registers a pair of similarity 0.8 is never in one bucket with a chance of 5e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.llm._common import cut, id_text, slices
from lodewatch.llm._shingles import mix, shingle_sets

_BANDS, _ROWS = 48, 6
_M = _BANDS * _ROWS
_BASE, _TOP = 1.001, 65534
_rng = np.random.default_rng(7)
_MUL = _rng.integers(0, 2**31, _M, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, _M, np.uint32)
#: A pair is dropped before verification if its likelihood at the threshold is e ** -_ODDS of the best: chance below 1e-10.
_ODDS = 25.0
#: Two classes of one bucket are of one family if they may be this alike: what links to one of them is then no further than this from the other.
_FAMILY = 0.4
#: Classes a block of a family holds, on its two sides.
_HEADS, _MEMBERS = 256, 512
#: Ids that may be broadcast; beyond it the join shuffles.
_BROADCAST_IDS = 1_000_000


def registers(elements: np.ndarray) -> np.ndarray:
    """The set's _M registers: min(max(floor(1 - log_b(x)), 0), _TOP) of the least exponential variable x."""
    x = mix(elements ^ np.uint64(0x5DEECE66D)).astype(np.uint32)
    least = np.full(_M, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, (x[i : i + 2048, None] * _MUL + _ADD).min(0), out=least)
    variable = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / 16.0
    return np.clip(np.floor(1 - np.log(variable) / np.log(_BASE)), 0, _TOP).astype(np.uint16)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, at: float) -> tuple[np.ndarray, np.ndarray]:
    """(maximum-likelihood Jaccard, log-likelihood lost at ``at`` if the estimate is lower, else 0) of pairs of register rows.

    With sizes known, a register is equal with chance J, and the first set's is greater with chance u - v J, the
    second's with v - u J, where u and v are the sizes' shares.
    """
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = _M - more - less
    u = na / (na + nb)
    v = 1 - u
    grid = np.linspace(0, 1, 101)[1:-1]
    top = np.minimum(u / v, v / u)[:, None]
    j = np.minimum(grid[None, :] * top, top - 1e-9)

    def likelihood(j: np.ndarray) -> np.ndarray:
        return same[:, None] * np.log(np.maximum(j, 1e-12)) + more[:, None] * np.log(np.maximum(u[:, None] - v[:, None] * j, 1e-9)) + less[:, None] * np.log(np.maximum(v[:, None] - u[:, None] * j, 1e-9))

    all_ = likelihood(j)
    best = all_.argmax(1)
    value, peak = np.take_along_axis(j, best[:, None], 1)[:, 0], all_.max(1)
    lost = np.where(value < at, peak - likelihood(np.full((len(u), 1), at))[:, 0], 0.0)
    return value, lost


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set; null if empty), registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, bytes] = {}
        for batch in slices(batches):
            sizes, digests, regs = [], [], []
            for x in shingle_sets(batch.column("text").to_pylist(), words):
                sizes.append(len(x))
                digest = hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None
                digests.append(digest)
                if digest is not None and digest not in kept:
                    if len(kept) > 5000:
                        kept.clear()
                    kept[digest] = registers(x).tobytes()
                regs.append(kept[digest] if digest is not None else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "digest", "registers"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, digest binary, registers binary")


def connected(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b): root is the least id reachable. Larger roots hook to their least neighbour and the graph is contracted until no edge is left."""
    roots = cut(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("root", F.col("id")), "roots")
    left = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    while not left.isEmpty():
        hook = cut(left.groupBy("a").agg(F.min("b").alias("to")), "hook")
        while True:  # follow hooks to their ends
            on = hook.join(hook.select(F.col("a").alias("to"), F.col("to").alias("further")), "to", "left")
            if on.filter("further is not null").isEmpty():
                break
            hook = cut(on.select("a", F.coalesce("further", "to").alias("to")), "hook")
        roots = cut(roots.join(hook.withColumnRenamed("a", "root"), "root", "left").select("id", F.coalesce("to", "root").alias("root")), "roots")
        half = left.join(hook, "a", "left").select(F.coalesce("to", "a").alias("a"), "b")
        whole = half.join(hook.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b", "left").select("a", F.coalesce("to_b", "b").alias("b"))
        left = cut(whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    return roots


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(id, root) after more ``links`` (a, b): only the roots they join are connected again."""
    of = lambda x: roots.select(F.col("id").alias(x), F.col("root").alias(f"root_{x}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    over = connected(between.distinct()).select(F.col("id").alias("root"), F.col("root").alias("top"))
    moved = roots.join(over, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    alone = over.join(roots.select(F.col("id").alias("root")), "root", "left_anti").select(F.col("root").alias("id"), F.col("top").alias("root"))
    return moved.union(alone)


def _estimated(pairs: DataFrame, reps: DataFrame, similarity: float, odds: float) -> DataFrame:
    """Pairs (a, b) whose sizes and registers do not rule out that similarity, with the estimate."""
    own = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                rows = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, _M) for c in ("r_a", "r_b")]
                sizes = [part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                value, lost = joint_estimate(*rows, *sizes, similarity)
                keep = pa.array((lost < odds) & (np.minimum(*sizes) >= (similarity - 1e-9) * np.maximum(*sizes)))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(value)], ["a", "b", "estimate"]).filter(keep)

    return pairs.join(own("b"), "b").join(own("a"), "a").mapInArrow(run, f"a {kind}, b {kind}, estimate double")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on their full sets."""
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column("x_a").to_pylist(), batch.column("x_b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("id").alias(x), F.col("elements").alias(f"x_{x}"))
    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: doc_id, n_shingles, class_id (least id with the same shingle set), component_id (least id reachable by links), kept.

    Two texts link if 100 * |intersection| >= percent * |union| of their shingle sets. A null or empty text has an
    empty set and links with nothing. Rows of one id are one document to its component. A row without an id takes its
    class's ids, is kept only if it has none, and joins no other text. No bucket, group or partner list is capped.
    """
    rows = id_text(docs, id_col, text_col)
    sketches = cut(sketch(rows, words), "sketches")
    classes = cut(sketches.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    owners = sketches.join(classes, "digest").filter("doc_id = class_id").dropDuplicates(["digest"])
    reps = cut(owners.select(F.col("class_id").alias("id"), F.col("n_shingles").alias("n"), "registers"), "representatives")

    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(_BANDS - 1)), lambda i: F.xxhash64(i, F.substr("registers", i * 2 * _ROWS + 1, F.lit(2 * _ROWS)))))
    banded = cut(reps.select("id", band.alias("bucket")), "bands")
    full = cut(banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("size")).filter("size > 1").select("bucket", "hub"), "buckets")
    members = cut(banded.join(full, "bucket"), "members")

    # First each class against the least class it meets in any bucket.
    met = cut(members.groupBy("id").agg(F.min("hub").alias("hub")), "met")
    sets = _sets(rows, met, words)
    least = met.select(F.col("hub").alias("a"), F.col("id").alias("b")).filter("a <> b")
    likely = cut(_estimated(least, reps, percent / 100, _ODDS), "likely")  # a table between, so that no task runs two Python workers
    links = cut(_verified(likely, sets, percent), "links")
    roots = connected(links)

    # Then the parts that still meet, if the classes by which they meet may be of some likeness.
    part = lambda x: roots.select(F.col("id").alias(x), F.col("root").alias(f"part_{x}"))
    apart = members.select(F.col("hub").alias("a"), F.col("id").alias("b")).filter("a <> b").join(part("a"), "a", "left").join(part("b"), "b", "left")
    apart = apart.select("a", "b", F.coalesce("part_a", "a").alias("part_a"), F.coalesce("part_b", "b").alias("part_b")).filter("part_a <> part_b").distinct()
    near = cut(apart, "apart")
    alike = cut(_estimated(near.select("a", "b"), reps, _FAMILY, _ODDS), "alike")
    families = connected(near.join(alike, ["a", "b"], "left_semi").select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
    more = cut(_in_families(met, roots, families, reps, sets, percent), "links")
    rest = cut(_in_buckets(members, met, roots, families, reps, sets, percent), "links")
    roots = _joined(roots, more.union(rest))

    same = classes.join(roots.withColumnRenamed("id", "class_id"), "class_id", "left").select(F.col("digest").alias("g"), "class_id", F.coalesce("root", "class_id").alias("component_id"))
    joined = sketches.select("doc_id", "n_shingles", "digest").join(cut(same, "components"), F.col("digest") == F.col("g"), "left")
    own = lambda c: F.coalesce(F.col(c), F.col("doc_id")).alias(c)
    return joined.select("doc_id", "n_shingles", own("class_id"), own("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets(rows: DataFrame, met: DataFrame, words: int) -> DataFrame:
    """id, elements: the full sets of the classes that meet any other."""
    ids = met.select(F.col("id").alias("doc_id"))
    ids = F.broadcast(ids) if met.count() <= _BROADCAST_IDS else ids
    kind = dict(rows.dtypes)["doc_id"]

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x.tobytes() for x in shingle_sets(part.column("text").to_pylist(), words)], pa.binary())], ["id", "elements"])

    return cut(rows.join(ids, "doc_id", "left_semi").mapInArrow(elements, f"id {kind}, elements binary"), "sets")


def _in_families(met: DataFrame, roots: DataFrame, families: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join parts of a family: its classes outside its largest part against all its classes, cell by cell."""
    parts = met.select("id").join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("part"))
    owned = parts.join(families.select(F.col("id").alias("part"), F.col("root").alias("family")), "part")
    sizes = cut(owned.groupBy("family", "part").agg(F.count("*").alias("size")), "parts")
    shape = sizes.groupBy("family").agg(F.max_by("part", F.struct("size", "part")).alias("largest"), F.sum("size").alias("all"), F.max("size").alias("most"))
    blocks = lambda n, per: F.ceil(n / F.lit(per)).cast("int")
    shape = cut(shape.select("family", "largest", blocks(F.col("all") - F.col("most"), _HEADS).alias("heads"), blocks(F.col("all"), _MEMBERS).alias("chunks")), "families")
    placed = cut(owned.join(shape, "family"), "family-members").join(reps, "id").join(sets, "id")
    turn = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    heads = placed.filter("part <> largest").select(F.lit(0).alias("side"), "family", turn(F.col("heads")).alias("head"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "part", "id", "registers", "elements")
    members = placed.select(F.lit(1).alias("side"), "family", F.explode(F.sequence(F.lit(0), F.col("heads") - 1)).alias("head"), turn(F.col("chunks")).alias("chunk"), "part", "id", "registers", "elements")
    columns = ("side", "family", "head", "chunk", "part", F.col("part").alias("group"), "id", "registers", "elements")
    kind = dict(reps.dtypes)["id"]
    return heads.unionByName(members).select(*columns).groupBy("family", "head", "chunk").applyInArrow(_linker(percent), f"a {kind}, b {kind}")


def _in_buckets(members: DataFrame, met: DataFrame, roots: DataFrame, families: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between families that meet in a bucket: its classes outside its hub's family against all its classes.

    Registers alone go first, so that full sets are shipped only for classes that may have a partner.
    """
    parts = met.select("id").join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("part"))
    grouped = parts.join(families.select(F.col("id").alias("part"), F.col("root").alias("family")), "part", "left")
    grouped = cut(grouped.select("id", "part", F.coalesce("family", "part").alias("group")), "groups")
    placed = members.join(grouped, "id").join(grouped.select(F.col("id").alias("hub"), F.col("group").alias("hub_group")), "hub")
    placed = placed.select("bucket", "id", "part", "group", (F.col("group") != F.col("hub_group")).alias("strange"))
    # Of two members, the hub and a stranger, nothing is left to compare.
    strange = placed.groupBy("bucket").agg(F.count_if("strange").alias("strangers"), F.count("*").alias("all")).filter("strangers > 0 and `all` > 2").drop("strangers", "all")
    kept = cut(placed.join(strange, "bucket"), "strangers")
    kind, bucket = dict(reps.dtypes)["id"], dict(members.dtypes)["bucket"]
    may = _cells(kept.join(reps.select("id", "n", "registers"), "id")).groupBy("bucket", "head", "chunk").applyInArrow(_marker(percent), f"bucket {bucket}, id {kind}")
    worth = cut(kept.join(may.distinct(), ["bucket", "id"], "left_semi"), "worth")
    full = _cells(worth.join(reps.select("id", "registers"), "id").join(sets, "id"))
    return full.groupBy("bucket", "head", "chunk").applyInArrow(_linker(percent), f"a {kind}, b {kind}")


def _cells(placed: DataFrame) -> DataFrame:
    """``placed`` dealt over the cells of its buckets: side 0 its strangers, side 1 all its classes."""
    blocks = lambda n, per: F.ceil(n / F.lit(per)).cast("int")
    shape = placed.groupBy("bucket").agg(blocks(F.count_if("strange"), _HEADS).alias("heads"), blocks(F.count("*"), _MEMBERS).alias("chunks")).filter("heads > 0")
    shaped = placed.join(shape, "bucket")
    turn = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    heads = shaped.filter("strange").withColumns({"side": F.lit(0), "head": turn(F.col("heads")), "chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))})
    return heads.unionByName(shaped.withColumns({"side": F.lit(1), "head": F.explode(F.sequence(F.lit(0), F.col("heads") - 1)), "chunk": turn(F.col("chunks"))}))


def _partners(regs: np.ndarray, n: np.ndarray, group: np.ndarray, to: np.ndarray, i: int, percent: int) -> np.ndarray:
    """Those of ``to`` outside i's group that sizes and registers leave a chance, the likeliest first."""
    keep = to[(group[to] != group[i]) & (100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i]))]
    keep = keep[(regs[keep] == regs[i]).sum(1) > _M * (percent / 100 - 0.25)]
    if not len(keep):
        return keep
    estimate, lost = joint_estimate(regs[keep], np.broadcast_to(regs[i], (len(keep), _M)), n[keep], np.full(len(keep), n[i]), percent / 100)
    return keep[lost < _ODDS][np.argsort(-estimate[lost < _ODDS], kind="stable")]


def _codes(values: list) -> np.ndarray:
    number = {v: k for k, v in enumerate(dict.fromkeys(values))}
    return np.array([number[v] for v in values])


def _marker(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Marks the classes of a cell that have a partner there by their registers."""

    def mark(cell: pa.Table) -> pa.Table:
        side, n = cell.column("side").to_numpy(), cell.column("n").to_numpy().astype(float)
        group = _codes(cell.column("group").to_pylist())
        regs = np.frombuffer(b"".join(cell.column("registers").to_pylist()), np.uint16).reshape(-1, _M)
        marked, to = np.zeros(len(side), bool), np.flatnonzero(side == 1)
        for i in np.flatnonzero(side == 0).tolist():
            partners = _partners(regs, n, group, to, i, percent)
            if len(partners):
                marked[i] = True
                marked[partners] = True
        return cell.select(["bucket", "id"]).filter(pa.array(marked))

    return mark


def _linker(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links of a cell's classes on side 0 with those of another group on side 1, as far as they join parts."""

    def link(cell: pa.Table) -> pa.Table:
        side = cell.column("side").to_numpy()
        ids, parts = cell.column("id").to_pylist(), cell.column("part").to_pylist()
        group = _codes(cell.column("group").to_pylist())
        regs = np.frombuffer(b"".join(cell.column("registers").to_pylist()), np.uint16).reshape(-1, _M)
        elements = [np.frombuffer(x, np.uint64) for x in cell.column("elements").to_pylist()]
        n = np.array([len(x) for x in elements], float)
        root = {p: p for p in parts}

        def find(p):
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        found, to = [], np.flatnonzero(side == 1)
        for i in np.flatnonzero(side == 0).tolist():
            for j in _partners(regs, n, group, to, i, percent).tolist():
                if find(parts[i]) != find(parts[j]) and _similar(elements[i], elements[j], percent):
                    root[find(parts[i])] = find(parts[j])
                    found.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([a for a, _ in found], cell.schema.field("id").type), "b": pa.array([b for _, b in found], cell.schema.field("id").type)})

    return link


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.intersect1d(x, y, assume_unique=True).size
    return 100 * both >= percent * (len(x) + len(y) - both)
