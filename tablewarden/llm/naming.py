"""Exact deduplication by deterministic block naming. Built-in functions only.

A text is cut into blocks of a fixed number of bytes. Equal blocks get one integer
name, by their rank in sorted order; then adjacent names are paired and the pairs are
named in the same way, until one name is left for each document. Names come from
sorting, never from a hash, so two documents share depth and name only if their texts
are equal byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, lookup_join

BLOCK_BYTES = 1024
ROWS_PER_BUCKET = 20_000
#: A block is heavy beyond so many rows, or beyond one in HEAVY_MOST of all, so that
#: there are at most HEAVY_MOST heavy blocks and their table may be broadcast.
HEAVY_ROWS = 10_000
HEAVY_MOST = 10_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z and nothing else; null as empty."""
    body = F.coalesce(text, F.lit(""))
    # lower() folds other letters too, so it serves only texts of single bytes.
    return F.when(F.octet_length(body) == F.length(body), F.lower(body)).otherwise(
        F.translate(body, UPPER, LOWER)
    )


def _block_count(body: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.octet_length(body) / F.lit(size))).cast("int")


def _blocks(body: str, size: int) -> Column:
    """The bytes of a column in blocks; an empty text is one empty block."""
    data = F.col(body).cast("binary")
    return F.transform(
        F.sequence(F.lit(0), _block_count(F.col(body), size) - 1),
        lambda i: F.substring(data, i * F.lit(size) + 1, F.lit(size)),
    )


def _name(bucket: Column, rank: Column) -> Column:
    return F.shiftleft(bucket.cast("long"), 32) + rank.cast("long")


def _buckets(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_BUCKET))


def _heavy_names(docs: DataFrame, size: int, total: int, heavy_rows: int) -> DataFrame | None:
    """(block, name below zero) of blocks that very many documents hold, or None.

    Counting goes by a hash, which decides only how a block is named, not what is equal.
    """
    blocks = docs.select(F.explode(_blocks("body", size)).alias("block")).withColumn(
        "h", F.xxhash64("block")
    )
    limit = max(heavy_rows, total // HEAVY_MOST)
    heavy = cut_lineage(blocks.groupBy("h").count().where(F.col("count") > limit).select("h"))
    if heavy.limit(1).count() == 0:
        return None
    distinct = blocks.join(F.broadcast(heavy), "h", "left_semi").select("block").distinct()
    return cut_lineage(distinct.select(
        "block", (-F.row_number().over(Window.orderBy("block"))).cast("long").alias("known")
    ))


def name_blocks(
    docs: DataFrame, size: int = BLOCK_BYTES, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """(row, pos, n, name, doc_id, sha): the named blocks of each row's normalised text.

    `row` numbers the rows of `docs`, which should be a table read from storage; `n` is
    the number of blocks. doc_id and the SHA-256 of the text are in the first block's
    row only. Texts are moved once: a block goes to the bucket of its hash, and its name
    is its rank among the distinct blocks there. Heavy blocks are named from a broadcast
    table instead and spread over all buckets.
    """
    bodies = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", lower_ascii(F.col("text")).alias("body")
    )
    counted = docs.select(
        _block_count(F.coalesce(F.col("text"), F.lit("")), size).cast("long").alias("n")
    )
    total = counted.agg(F.sum("n")).first()[0] or 0
    heavy = _heavy_names(bodies, size, total, heavy_rows)
    rows = bodies.select(
        "row", "doc_id", _block_count(F.col("body"), size).alias("n"),
        F.unhex(F.sha2("body", 256)).alias("sha"),
        F.posexplode(_blocks("body", size)).alias("pos", "block"),
    )
    if heavy is None:
        rows = rows.withColumn("known", F.lit(None).cast("long"))
    else:
        rows = rows.join(F.broadcast(heavy), "block", "left")
    first, light = F.col("pos") == 0, F.col("known").isNull()
    dealt = rows.select(
        "row", "pos", "n", "known",
        F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha")).alias("sha"),
        F.when(light, F.col("block")).alias("block"),
        F.pmod(
            F.when(light, F.xxhash64("block")).otherwise(F.xxhash64("row", "pos")),
            F.lit(_buckets(total)),
        ).alias("bucket"),
    )
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("block"))
    return cut_lineage(dealt.withColumn("rank", rank).select(
        "row", "pos", "n", F.coalesce("known", _name(F.col("bucket"), F.col("rank"))).alias("name"),
        "doc_id", "sha",
    ))


def name_rows(named: DataFrame) -> DataFrame:
    """(row, depth, name): pairs of adjacent names are named until each row has one.

    An odd name at the end is paired with 0, which is no block's or pair's name. Only
    rows with more than one name left take part in a round.
    """
    longest = named.agg(F.max("n")).first()[0] or 1
    done = [named.where("n = 1").select("row", F.lit(0).alias("depth"), "name")]
    left, depth = named.where("n > 1").select("row", "pos", "n", "name"), 0
    while longest > 1:
        depth += 1
        even = F.col("pos") % 2 == 0
        pairs = cut_lineage(
            left.groupBy("row", F.shiftright("pos", 1).alias("pos"),
                         F.shiftright(F.col("n") + 1, 1).alias("n"))
            .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(0).cast("long")).alias("b"))
        )
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("a", "b"))
        names = (
            pairs.select("a", "b").distinct()
            .withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(_buckets(pairs.count()))))
            .select("a", "b", _name(F.col("bucket"), rank).alias("name"))
        )
        level = cut_lineage(
            lookup_join(pairs, names, ["a", "b"], "inner").select("row", "pos", "n", "name")
        )
        done.append(level.where("n = 1").select("row", F.lit(depth).alias("depth"), "name"))
        left, longest = level.where("n > 1"), (longest + 1) // 2
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def find_copies(
    docs: DataFrame, size: int = BLOCK_BYTES, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row of `docs`.

    Of equal texts (A-Z as a-z, null as empty) the row with the largest doc_id stays; a
    row without an id stays only if none of its group has one. Of rows that share the
    largest id exactly one stays. Other columns of `docs` are not read.
    """
    named = name_blocks(docs, size, heavy_rows)
    facts = named.where("pos = 0").select("row", "doc_id", "sha")
    rows = cut_lineage(facts.join(name_rows(named), "row"))
    groups = rows.groupBy("depth", "name").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top")
    )
    return lookup_join(rows, groups, ["depth", "name"], "inner").select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
