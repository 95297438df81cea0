"""Token-id files: every document a zstandard frame of its own, with a dictionary shared by all of them.

Format. ``<path>/dictionary`` holds one row (sha256, zstandard dictionary, tokenizer file name, end id, id width).
``<path>/blocks`` holds blocks of documents in ascending id order, as Parquet rows so that any store Spark
writes to will do: ``shard, block, ids_before`` (ids of the shard in earlier blocks), ``n_ids, dict_sha256, width,
doc_ids`` and ``n_tokens`` (one entry a document), ``offsets`` (one more entry; document i is the frame
``payload[offsets[i]:offsets[i + 1]]``) and ``payload``. Parquet's statistics on ``first_doc``/``last_doc`` find a document's
block; its offset index finds the frame, so a short document costs one small read and one small decompression.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.llm._common import id_text, slices
from lodewatch.llm.tokens import encode_rows, encoder, tokenizer_path

_BLOCK = "shard int, block int, first_doc {id}, last_doc {id}, ids_before long, n_ids long, dict_sha256 string, width int, doc_ids array<{id}>, n_tokens array<long>, offsets array<long>, payload binary"


def _kind(width: int) -> str:
    return f"<u{width}"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int | None = 1, sample_docs: int = 1024, sample_chars: int = 4096, size: int = 32768) -> DataFrame:
    """One row (sha256, dictionary, width): a zstandard dictionary of at most ``size`` bytes.

    It is fitted to a piece of ``sample_chars`` characters, from a hashed place, of each of the ``sample_docs``
    documents whose hashes are smallest, so its cost does not grow with the corpus; it only affects the files' size,
    never what they hold. With too little to train on, the sample itself is the dictionary; an empty table gives an
    empty one. Repeated rows count as one.
    """
    # Of all hashes only the share that holds about four samples is sorted, so that no task is sent more as tables grow.
    share = min(1.0, 4 * sample_docs / max(1, docs.count()))
    place = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - sample_chars + 1)).cast("int") + 1
    low = id_text(docs).withColumn("h", F.xxhash64("doc_id", "text")).filter(F.col("h") <= min(2**63 - 1, int(share * 2**64) - 2**63))
    pieces = low.select("h", F.substring("text", place, F.lit(sample_chars)).alias("text")).groupBy("h").agg(F.min("text").alias("text"))
    sample = pieces.orderBy("h").limit(sample_docs)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        texts = [t for b in batches for t in b.column("text").to_pylist()]
        parts = [x.tobytes() for x in encode_rows(texts, tokenizer, end_id)]
        width = np.dtype(next(iter(encode_rows([""], tokenizer, 0))).dtype).itemsize
        try:
            data = zstd.train_dictionary(size, parts).as_bytes()
        except (zstd.ZstdError, ValueError):
            data = b"".join(parts)[-size:]
        yield pa.RecordBatch.from_pydict({"sha256": [hashlib.sha256(data).hexdigest()], "dictionary": [data], "width": pa.array([width], pa.int32())})

    return sample.coalesce(1).mapInArrow(train, "sha256 string, dictionary binary, width int")


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int | None = 1, level: int = 1, block_bytes: int = 4 << 20, range_bytes: int = 32 << 20, max_ranges: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes the files described above to ``path``.

    Rows are dealt by ranges of id and sorted inside each range, so shards follow one another in ascending order. There
    are as many ranges as ``range_bytes`` of text each ask for, so a task stays of one size however large the corpus;
    beyond ``max_ranges`` they grow instead, since a shuffle's bookkeeping does too.
    Repeated ids each keep their frame, in the order of their texts' hashes; a null id comes first. No row is
    dropped; an empty table writes no block. Other columns are not looked at.
    """
    spark, tokenizer = docs.sparkSession, tokenizer or tokenizer_path()
    rows = id_text(docs, id_col, text_col)
    made = train_dictionary(rows, tokenizer, end_id).collect()  # a row, or none for an empty table
    sha, dictionary, width = (made[0].sha256, bytes(made[0].dictionary), made[0].width) if made else (hashlib.sha256(b"").hexdigest(), b"", encoder(tokenizer).kind.itemsize)
    spark.createDataFrame([(sha, dictionary, width)], "sha256 string, dictionary binary, width int").write.parquet(f"{path}/dictionary")
    schema = _BLOCK.format(id=dict(rows.dtypes)["doc_id"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        packer = zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)
        ids, counts, frames, held, before, block, types = [], [], [], 0, 0, 0, None

        def flush() -> pa.RecordBatch:
            n = sum(counts)
            cells = {"shard": shard, "block": block, "first_doc": next((x for x in ids if x is not None), None), "last_doc": ids[-1], "ids_before": before, "n_ids": n, "dict_sha256": sha, "width": width, "doc_ids": ids, "n_tokens": counts, "offsets": np.cumsum([0, *map(len, frames)]).tolist(), "payload": b"".join(frames)}
            return pa.RecordBatch.from_pydict({k: [v] for k, v in cells.items()}, schema=types)

        for batch in slices(batches):
            id_type = batch.schema.field("doc_id").type
            types = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_doc", id_type), ("last_doc", id_type), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("dict_sha256", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(id_type)), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())])
            for key, x in zip(batch.column("doc_id").to_pylist(), encode_rows(batch.column("text").to_pylist(), tokenizer, end_id), strict=True):
                frame = packer.compress(x.astype(_kind(width), copy=False).tobytes())
                ids.append(key)
                counts.append(len(x))
                frames.append(frame)
                held += len(frame)
                if held >= block_bytes:
                    yield flush()
                    before, block, held = before + sum(counts), block + 1, 0
                    ids, counts, frames = [], [], []
        if ids:
            yield flush()

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(min(-(-size // range_bytes), max_ranges), spark.sparkContext.defaultParallelism)
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    dealt.mapInArrow(encode, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Reads every document back: doc_id, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit).

    Only one total for each shard (as many as the writing job had tasks) passes through the driver.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = dict(blocks.dtypes)["first_doc"]
    totals = sorted((r.shard, r.n) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    before, at = {}, 0
    for shard, n in totals:
        before[shard] = at
        at += n
    made = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, sha = bytes(made.dictionary), made.sha256

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        opener = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name, b=batch, r=r: b.column(name)[r]
                if get("dict_sha256").as_py() != sha:
                    raise ValueError("a block was written with another dictionary")
                payload, at, n = get("payload").as_buffer(), np.array(get("offsets").values), np.array(get("n_tokens").values)
                kind, start = _kind(get("width").as_py()), before[get("shard").as_py()] + get("ids_before").as_py()
                ids = [np.frombuffer(opener.decompress(payload[a:b]), kind).astype("<u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([get("doc_ids").values, pa.array(start + np.cumsum(n) - n, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.select("shard", "ids_before", "dict_sha256", "width", "doc_ids", "n_tokens", "offsets", "payload").mapInArrow(decode, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id) -> list[np.ndarray]:
    """The id arrays of the documents with this id, by block statistics and offset index; other frames stay closed."""
    import zstandard as zstd

    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    opener = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(dictionary) if dictionary else None)
    rows = spark.read.parquet(f"{path}/blocks").filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).filter(F.array_contains("doc_ids", doc_id)).orderBy("shard", "block").collect()
    return [np.frombuffer(opener.decompress(bytes(r.payload[r.offsets[i] : r.offsets[i + 1]])), _kind(r.width)) for r in rows for i, d in enumerate(r.doc_ids) if d == doc_id]
