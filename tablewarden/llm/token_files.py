"""Token ids in binary blocks, each document compressed by itself with a shared dictionary.

A file set has two tables. `dictionary` has one row: a zstandard dictionary
trained on serialised id arrays, its SHA-256, and the width of an id in bytes.
`blocks` has rows of about a megabyte: the compressed documents one after the
other, and an index of their ids, byte offsets and lengths in tokens. Blocks are
numbered in the order of document ids. A single document is read by its block's
range of ids and its offset, without decompressing its neighbours. Each block
names the dictionary it needs by hash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablewarden.context import shared_dir, ship_package, small_or_shuffled
from tablewarden.llm.bpe import Encoder, WordEncoder, tokenizer
from tablewarden.llm.order import pieces_of, split_points
from tablewarden.llm.tables import map_batches, pa_schema, texts_of
from tablewarden.llm.words import groups

#: The dictionary is trained on so many documents at most (least hash of the id), of so many bytes.
TRAINING_ROWS = 1_000
TRAINING_TEXT_BYTES = 1 << 16
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 1 << 20
LEVEL = 3

BLOCKS = (
    "shard int, block int, dictionary_hash string, min_id long, max_id long, has_null boolean, "
    "documents long, tokens long, ids binary, nulls binary, offsets binary, lengths binary, "
    "payload binary"
)


def _packed(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes()


def _with_end(encode: Encoder, texts: Sequence[bytes], end_id: int) -> list[bytes]:
    end = np.array([end_id], dtype="<u4").tobytes()
    return [ids + end for ids in encode(texts)]


def train_dictionary(
    docs: DataFrame, width: int, encode: Callable[[Sequence[bytes]], list[bytes]]
) -> bytes:
    """A dictionary from a bounded sample of whole documents; empty if they are too few or too short."""
    usable = docs.where(F.octet_length("text") <= TRAINING_TEXT_BYTES).select("doc_id", "text")
    # Ids are chosen without the texts, so that no task sends a thousand texts to the driver.
    chosen = (
        usable.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_ROWS)
    )
    sample = (
        usable.join(F.broadcast(chosen), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(TRAINING_ROWS).collect()
    )
    arrays = [_packed(ids, width) for ids in encode([r.text.encode() for r in sample])]
    size = min(DICTIONARY_BYTES, sum(map(len, arrays)) // 10)
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _codec(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=data),
            zstandard.ZstdDecompressor(dict_data=data))


def write_tokens(docs: DataFrame, target: str, path: str, end_id: int) -> None:
    """Encode every text and write the file set at `target`, in ascending order of doc_id.

    Null and empty texts have the end id alone. Rows without an id come first;
    rows with equal ids are ordered by their compressed bytes.
    """
    spark = docs.sparkSession
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    dictionary = train_dictionary(docs, width, lambda texts: _with_end(WordEncoder(path), texts, end_id))
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame(
        [(digest, bytearray(dictionary), width)], "hash string, dictionary binary, width int"
    ).write.parquet(f"{target}/dictionary")
    points = split_points(docs)

    def make():
        encode, (compressor, _) = WordEncoder(path), _codec(dictionary)

        def step(batch):
            texts = texts_of(batch)
            every = batch.column(batch.schema.get_field_index("doc_id"))
            # Ids of a few megabytes of text at a time, for they are larger than their frames.
            for low, high in groups(texts):
                ids = every.slice(low, high - low)
                arrays = _with_end(encode, texts[low:high], end_id)
                yield {
                    "piece": pieces_of(ids, points), "doc_id": ids,
                    "n": [len(a) // 4 for a in arrays],
                    "frame": [compressor.compress(_packed(a, width)) for a in arrays],
                }
        return step

    frames = map_batches(
        docs.select("doc_id", "text"), "piece int, doc_id long, n long, frame binary", make
    )
    ship_package(spark)
    ordered = frames.repartition("piece").sortWithinPartitions("piece", "doc_id", "frame")
    ordered.mapInArrow(_blocks(digest), T.StructType.fromDDL(BLOCKS)).write.parquet(f"{target}/blocks")


def _blocks(digest: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order -> blocks of one piece each."""
    schema = pa_schema(T.StructType.fromDDL(BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, number, size = None, 0, 0
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids = [r[0] for r in rows]
            present = [i for i in ids if i is not None]
            frames = [r[2] for r in rows]
            block = (
                piece, number, digest, min(present, default=None), max(present, default=None),
                len(present) < len(ids), len(rows), sum(r[1] for r in rows),
                np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
                np.array([i is None for i in ids], dtype="u1").tobytes(),
                np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8").tobytes(),
                np.array([r[1] for r in rows], dtype="<u8").tobytes(),
                b"".join(frames),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=f.type) for v, f in zip(block, schema)], schema=schema
            )

        for batch in batches:
            for p, doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (p != piece or size >= BLOCK_BYTES):
                    yield flush()
                    number = number + 1 if p == piece else 0
                    rows, size = [], 0
                piece = p
                rows.append((doc_id, n, frame))
                size += len(frame)
        if rows:
            yield flush()

    return run


def _dictionary(spark: SparkSession, target: str) -> tuple[bytes, int, str]:
    row = spark.read.parquet(f"{target}/dictionary").first()
    dictionary = bytes(row.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != row.hash:
        raise ValueError("the dictionary is damaged")
    return dictionary, row.width, row.hash


def _check(batch: pa.RecordBatch, digest: str) -> None:
    for found in batch.column(batch.schema.get_field_index("dictionary_hash")).to_pylist():
        if found != digest:
            raise ValueError(f"a block was written with the dictionary {found}")


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in a file set."""
    dictionary, width, digest = _dictionary(spark, target)
    blocks = spark.read.parquet(f"{target}/blocks")
    # Tokens before a block: whole shards before its shard, and blocks before it there.
    sizes = blocks.select("shard", "block", "tokens")
    shards = sizes.groupBy("shard").agg(F.sum("tokens").alias("n")).select(
        "shard",
        F.coalesce(
            F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("base"),
    )
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(
        shards, "shard"
    ).select("shard", "block", (F.col("base") + F.col("inner")).alias("first"))
    placed = blocks.join(small_or_shuffled(starts), ["shard", "block"])

    def make():
        _, decompressor = _codec(dictionary)

        def step(batch):
            _check(batch, digest)
            out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
            for ids, nulls, offsets, lengths, payload, first in zip(
                *(batch.column(batch.schema.get_field_index(c)).to_pylist()
                  for c in ("ids", "nulls", "offsets", "lengths", "payload", "first"))
            ):
                names = np.frombuffer(ids, "<i8").tolist()
                at = np.frombuffer(offsets, "<u8").tolist()
                start = first
                for k, n in enumerate(np.frombuffer(lengths, "<u8").tolist()):
                    raw = decompressor.decompress(payload[at[k] : at[k + 1]])
                    values = np.frombuffer(raw, f"<u{width}").astype("<u4")
                    if len(values) != n:
                        raise ValueError("a document has another length than its index says")
                    out["doc_id"].append(None if nulls[k] else names[k])
                    out["start"].append(start)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(values.tobytes()))
                    start += n
            return out
        return step

    return map_batches(
        placed.select("dictionary_hash", "ids", "nulls", "offsets", "lengths", "payload", "first"),
        "doc_id long, start long, n_tokens long, ids_crc32 long", make,
    )


def read_documents(spark: SparkSession, target: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id and ids of a few documents. Only blocks whose range holds one are read,
    and only the asked frames are decompressed."""
    wanted = sorted(set(doc_ids))
    dictionary, width, digest = _dictionary(spark, target)
    near = F.lit(False)
    for i in wanted:
        near = near | ((F.col("min_id") <= i) & (F.col("max_id") >= i))

    def make():
        _, decompressor = _codec(dictionary)
        asked = set(wanted)

        def step(batch):
            _check(batch, digest)
            out: dict[str, list] = {"doc_id": [], "ids": []}
            for ids, nulls, offsets, payload in zip(
                *(batch.column(batch.schema.get_field_index(c)).to_pylist()
                  for c in ("ids", "nulls", "offsets", "payload"))
            ):
                at = np.frombuffer(offsets, "<u8")
                for k, i in enumerate(np.frombuffer(ids, "<i8").tolist()):
                    if i in asked and not nulls[k]:
                        raw = decompressor.decompress(payload[at[k] : at[k + 1]])
                        out["doc_id"].append(i)
                        out["ids"].append(np.frombuffer(raw, f"<u{width}").astype(np.int64))
            return out
        return step

    return map_batches(
        spark.read.parquet(f"{target}/blocks").where(near)
        .select("dictionary_hash", "ids", "nulls", "offsets", "payload"),
        "doc_id long, ids array<long>", make,
    )


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write a file set in the shared folder and read it back."""
    target = f"{shared_dir(docs.sparkSession)}/tokens"
    write_tokens(docs, target, path, end_id)
    return read_tokens(docs.sparkSession, target)
