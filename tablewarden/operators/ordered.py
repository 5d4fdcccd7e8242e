"""Order-dependent steps that hold up when one key owns much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, small_or_shuffled


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key; `order` decides, later columns break ties.

    `row_number() = 1` becomes a group-limited window: each task keeps its own
    best row per key before the shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first `n` rows per key, limited on the map side in the same way."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= n)


GROUP_ROWS = 1_000_000


def split_by_weight(
    df: DataFrame, keys: list[str], max_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key has at most `max_rows` rows, and the others (None without any).

    Sizes come from one count per key with map-side partials.
    """
    heavy = cut_lineage(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > max_rows)
        .select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    )
    if heavy.isEmpty():
        return df, None
    marked = small_or_shuffled(heavy)
    same = _same_keys(keys)
    return df.join(marked, same, "left_anti"), df.join(marked, same, "left_semi")


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str],
    max_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add, per row, values of the row before it within its key.

    `previous` maps new column -> source column. Keys of moderate size use a
    plain window. Keys with more rows than one task should sort go through
    `previous_over_pieces`.
    """
    light, heavy = split_by_weight(df, keys, max_rows)
    window = Window.partitionBy(*keys).orderBy(*order)
    out = light.withColumns({new: F.lag(old).over(window) for new, old in previous.items()})
    if heavy is None:
        return out
    return out.unionByName(previous_over_pieces(heavy, keys, order, previous))


def previous_over_pieces(
    df: DataFrame, keys: list[str], order: list[str], previous: dict[str, str]
) -> DataFrame:
    """`with_previous` for keys too large for one task.

    Rows are range-partitioned by key and order, which splits a long timeline
    over many partitions; the split is materialised so that partition numbers
    stay put, each piece is windowed alone, and the last row of the piece before
    is carried over the seam. Neighbouring range partitions share at most one
    key, so fewer rows are carried than there are partitions, and broadcasting
    them is safe.
    """
    pieces = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in (*keys, *order)]).withColumn(
            "_piece", F.spark_partition_id()
        )
    )
    within = Window.partitionBy("_piece", *keys).orderBy(*order)
    sources = list(dict.fromkeys(previous.values()))
    ends = pieces.select("_piece", *keys, *order, F.struct(*sources).alias("_tail"))
    carried = (
        latest_by_key(ends, ["_piece", *keys], order)
        .withColumn("_carry", F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_piece")))
        .filter(F.col("_carry").isNotNull())
        .select(
            F.col("_piece").alias("_carry_piece"),
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            "_carry",
        )
    )
    local = pieces.withColumns(
        {
            "_first": F.row_number().over(within) == 1,
            **{new: F.lag(old).over(within) for new, old in previous.items()},
        }
    )
    seam = (F.col("_piece") == F.col("_carry_piece")) & _same_keys(keys)
    return local.join(F.broadcast(carried), seam, "left").select(
        *df.columns,
        *[
            F.when(F.col("_first"), F.col("_carry")[old]).otherwise(F.col(new)).alias(new)
            for new, old in previous.items()
        ],
    )


def _same_keys(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return same
