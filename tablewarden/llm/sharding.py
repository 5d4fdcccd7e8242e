"""Rendezvous (highest random weight) sharding of records by a stable key. Built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, small_or_shuffled

ROWS_PER_BUCKET = 50_000
_TOP = float(1 << 52)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among `len(weights)` shards.

    Each shard draws a number u in (0, 1) from the key and its own number, and
    the least -ln(u) / weight wins. A shard gets keys in proportion to its weight.
    One more shard draws for itself alone, so keys move only into it. A null key
    is a key of its own.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))

    def cost(shard: int) -> Column:
        digest = F.md5(F.concat(text, F.lit(f"/{shard}")).cast("binary"))
        drawn = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(_TOP)
        return F.struct((-F.log(drawn) / F.lit(float(weights[shard]))).alias("cost"),
                        F.lit(shard).alias("shard"))

    return F.array_min(F.array(*map(cost, range(len(weights))))).getField("shard").cast("int")


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    weights: Sequence[float] | None = None,
    key: str = "doc_id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (with one shard more) of each row.

    `slot` numbers the rows of a shard without gaps. Rows are ranked only within
    buckets of a shard, whose number follows the row count; the rows of earlier
    buckets come from a small table of counts. Null texts have no bytes. Equal
    rows get slots of their own. Repeated keys meet in one shard, as they must.
    """
    weights = list(weights or [1.0] * shards)
    added = sum(weights) / len(weights)
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = cut_lineage(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
        )
    )
    buckets = max(1, -(-rows.count() // (len(weights) * rows_per_bucket)))
    placed = rows.select(
        "*",
        rendezvous_shard(F.col("doc_id"), weights).alias("shard"),
        rendezvous_shard(F.col("doc_id"), [*weights, added]).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).alias("bucket"),
    )
    # Ranks need each bucket together; what lies before a bucket is a sum over counts.
    ranked = placed.withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
        ) - 1,
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    starts = small_or_shuffled(cut_lineage(starts))
    return ranked.join(starts, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("rank")).alias("slot"),
        "grown_shard",
    )
