"""Two-level digests of a table: which key buckets of two sides can differ at all.

A digest of a bucket is its number of rows and an order-free sum and xor of 64-bit row
hashes, taken with two different hashes. Coarse buckets are compared first; only those
that differ are cut into fine ones, and only rows of fine buckets that differ are moved.
Two equal tables exchange one small row for each task and coarse bucket. Unequal buckets
with equal digests would need 128 bits to agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import cut_lineage, small_or_shuffled

COARSE = 1_024
ROWS_PER_BUCKET = 64
MOST_BUCKETS = 1 << 22
_SECOND = "tablewarden"


def _hashable(df: DataFrame, name: str) -> Column:
    """Maps and variants have no hash; their text has."""
    kind = df.schema[name].dataType
    plain = isinstance(kind, T.AtomicType) and not isinstance(kind, T.VariantType)
    return F.col(f"`{name}`") if plain else F.to_json(F.struct(F.col(f"`{name}`")))


def _keyed(df: DataFrame, key: list[str], columns: list[str], buckets: int) -> list[Column]:
    values = [_hashable(df, c) for c in [*key, *columns]]
    # A null and a missing neighbour must not look alike, so nulls are counted by place.
    nulls = F.concat(*[F.when(F.isnull(v), F.lit("0")).otherwise(F.lit("1")) for v in values])
    return [
        bucket(key, buckets).alias("bucket"),
        F.xxhash64(nulls, *values).alias("h1"),
        F.xxhash64(F.lit(_SECOND), *reversed(values), nulls).alias("h2"),
    ]


def bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets))


def _compared(
    legacy: DataFrame, new: DataFrame, key: list[str], columns: list[str], buckets: int
) -> DataFrame:
    """bucket, rows of both sides, and whether the sides differ there."""
    both = legacy.select(F.lit(False).alias("_new"), *_keyed(legacy, key, columns, buckets)).unionByName(
        new.select(F.lit(True).alias("_new"), *_keyed(new, key, columns, buckets))
    )

    def side(new_side: bool, name: str) -> list[Column]:
        mine = F.col("_new") if new_side else ~F.col("_new")
        return [
            F.count_if(mine).alias(f"n_{name}"),
            F.sum(F.when(mine, F.col("h1").cast("decimal(20,0)"))).alias(f"sum_{name}"),
            F.bit_xor(F.when(mine, F.col("h2"))).alias(f"xor_{name}"),
        ]

    digests = both.groupBy("bucket").agg(*side(False, "legacy"), *side(True, "new"))
    differs = (
        (F.col("n_legacy") != F.col("n_new"))
        | ~F.col("sum_legacy").eqNullSafe(F.col("sum_new"))
        | ~F.col("xor_legacy").eqNullSafe(F.col("xor_new"))
    )
    return digests.select("bucket", "n_legacy", "n_new", differs.alias("differs"))


def differing_rows(
    legacy: DataFrame, new: DataFrame, key: list[str], columns: list[str]
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides, cut down to the buckets in which they differ; None if they differ nowhere.

    Both need `key` and `columns` with equal types.
    """
    coarse = cut_lineage(_compared(legacy, new, key, columns, COARSE))
    size, unequal = coarse.agg(
        F.sum(F.greatest("n_legacy", "n_new")), F.count_if("differs")).first()
    if not unequal:
        return None
    # There are at most COARSE of them.
    first = F.broadcast(coarse.filter("differs").select("bucket"))

    def cut(df: DataFrame, buckets: int, found: DataFrame) -> DataFrame:
        marked = df.withColumn("bucket", bucket(key, buckets))
        return marked.join(found, "bucket", "left_semi").drop("bucket")

    fine = min(MOST_BUCKETS, COARSE * max(1, size // (COARSE * ROWS_PER_BUCKET)))
    if fine == COARSE:
        return cut(legacy, COARSE, first), cut(new, COARSE, first)
    second = small_or_shuffled(cut_lineage(
        _compared(cut(legacy, COARSE, first), cut(new, COARSE, first), key, columns, fine)
        .filter("differs").select("bucket")))
    return cut(legacy, fine, second), cut(new, fine, second)
