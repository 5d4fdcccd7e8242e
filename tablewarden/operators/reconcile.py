"""Compare a migrated table with its legacy original.

All scalar checks come from one aggregation over both sides, tagged and
unioned: one scan per side, one exchange of partial aggregates. Each check is a
row (check_name, item, legacy, new, delta, passed).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import cut_lineage, small_or_shuffled
from tablewarden.operators.digest import differing_rows

MONEY = T.DecimalType(18, 2)
WIDE = T.DecimalType(38, 0)
DEFAULT_TOLERANCE = 0.001


@dataclass(frozen=True)
class Tolerances:
    row_count: float = DEFAULT_TOLERANCE
    null_rate: float = DEFAULT_TOLERANCE
    metric: float = DEFAULT_TOLERANCE


def key_hash(key: list[str]) -> Column:
    """The first 32 bits of the key's md5 as an unsigned number.

    Key parts are length-prefixed, so ('a', 'bc') and ('ab', 'c') differ.
    """
    if len(key) == 1:
        text = F.coalesce(F.col(key[0]).cast("string"), F.lit("\\N"))
    else:
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in key]
        text = F.concat_ws("|", *[F.concat(F.length(p), F.lit(":"), p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _common(legacy: DataFrame, new: DataFrame) -> list[str]:
    return [c for c in legacy.columns if c in set(new.columns)]


def _both(legacy: DataFrame, new: DataFrame, columns) -> DataFrame:
    """Both sides projected by `columns(df)`, tagged with `_new`."""
    return legacy.select(F.lit(False).alias("_new"), *columns(legacy)).unionByName(
        new.select(F.lit(True).alias("_new"), *columns(new))
    )


def _sides(name: str, aggregate) -> list[Column]:
    return [
        aggregate(~F.col("_new")).alias(f"{name}_legacy"),
        aggregate(F.col("_new")).alias(f"{name}_new"),
    ]


def _check(name: str, item: str, legacy: Column, new: Column, delta: Column, passed: Column):
    number = T.DecimalType(38, 6)
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(item).alias("item"),
        legacy.cast(number).alias("legacy"),
        new.cast(number).alias("new"),
        F.round(delta, 6).alias("delta"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _relative(legacy: Column, new: Column) -> Column:
    """|new - legacy| / |legacy|; nothing against nothing is 0, something against nothing 1."""
    legacy, new = legacy.cast("double"), new.cast("double")
    return (
        F.when(legacy == new, F.lit(0.0))
        .when(legacy == 0, F.lit(1.0))
        .otherwise(F.abs(new - legacy) / F.abs(legacy))
    )


def _profile_checks(
    legacy: DataFrame,
    new: DataFrame,
    key: list[str] | None,
    null_columns: list[str],
    metrics: list[str],
    tol: Tolerances,
    kinds: Iterable[str],
) -> DataFrame:
    kinds = set(kinds)
    usable = [m for m in metrics if _is_number(legacy, m) and _is_number(new, m)]
    unusable = [m for m in metrics if m not in usable] if "metric" in kinds else []
    metrics = usable

    def columns(df: DataFrame):
        out = [F.isnull(c).alias(f"null_{i}") for i, c in enumerate(null_columns)]
        for i, m in enumerate(metrics):
            money = F.col(m).try_cast(MONEY)
            out.append(money.alias(f"metric_{i}"))
            out.append((F.isnull(money) & F.isnotnull(m)).alias(f"lost_{i}"))
        if key and "key_hash" in kinds:
            out.append(key_hash(key).cast(WIDE).alias("key_hash"))
        if key and "not_null" in kinds:
            no_key = reduce(lambda a, b: a | b, [F.isnull(k) for k in key])
            out.append(no_key.alias("no_key"))
        return out

    aggregates = _sides("rows", F.count_if)
    checks: list[Column] = []
    rows = (F.col("rows_legacy"), F.col("rows_new"))
    if "row_count" in kinds:
        delta = _relative(*rows)
        checks.append(_check("row_count", "rows", *rows, delta, delta <= tol.row_count))
    if "key_hash" in kinds:
        aggregates += _sides("hash", lambda side: F.sum(F.when(side, F.col("key_hash"))))
        hashes = [F.coalesce(F.col(f"hash_{s}"), F.lit(0).cast(WIDE)) for s in ("legacy", "new")]
        same = (hashes[0] == hashes[1]) & (rows[0] == rows[1])
        checks.append(
            _check(
                "key_hash", ",".join(key), *hashes, F.when(same, 0.0).otherwise(1.0), same
            )
        )
    if "not_null" in kinds:
        aggregates += _sides("no_key", lambda side: F.count_if(side & F.col("no_key")))
        bare = (F.col("no_key_legacy"), F.col("no_key_new"))
        checks.append(
            _check(
                "key_not_null",
                ",".join(key),
                *bare,
                F.greatest(*bare).cast("double"),
                F.greatest(*bare) == 0,
            )
        )
    if "null_rate" in kinds:
        for i, name in enumerate(null_columns):
            aggregates += _sides(
                f"null_{i}", lambda side, i=i: F.count_if(side & F.col(f"null_{i}"))
            )
            rates = [
                F.coalesce(
                    F.try_divide(F.col(f"null_{i}_{s}"), F.col(f"rows_{s}")), F.lit(0.0)
                ).cast("double")
                for s in ("legacy", "new")
            ]
            delta = F.abs(rates[1] - rates[0])
            checks.append(
                _check(
                    "null_rate", name, *[F.round(r, 6) for r in rates], delta, delta <= tol.null_rate
                )
            )
    if "metric" in kinds:
        for i, name in enumerate(metrics):
            aggregates += _sides(
                f"sum_{i}", lambda side, i=i: F.sum(F.when(side, F.col(f"metric_{i}")))
            )
            aggregates += _sides(
                f"n_{i}", lambda side, i=i: F.count(F.when(side, F.col(f"metric_{i}")))
            )
            aggregates.append(F.count_if(F.col(f"lost_{i}")).alias(f"lost_{i}"))
            sums = [F.coalesce(F.col(f"sum_{i}_{s}"), F.lit(0)) for s in ("legacy", "new")]
            means = [
                F.round(
                    F.coalesce(
                        F.try_divide(
                            F.col(f"sum_{i}_{s}").cast("double"), F.col(f"n_{i}_{s}").cast("double")
                        ),
                        F.lit(0.0),
                    ),
                    6,
                )
                for s in ("legacy", "new")
            ]
            for kind, pair in (("sum", sums), ("avg", means)):
                delta = _relative(*pair)
                passed = (delta <= tol.metric) & (F.col(f"lost_{i}") == 0)
                checks.append(_check(f"metric_{kind}", name, *pair, delta, passed))
    none = F.lit(None)
    for name in unusable:
        for kind in ("sum", "avg"):
            checks.append(_check(f"metric_{kind}", name, none, none, F.lit(1.0), F.lit(False)))
    profile = _both(legacy, new, columns).agg(*aggregates)
    return profile.select(F.inline(F.array(*checks)))


def _is_number(df: DataFrame, name: str) -> bool:
    return name in df.columns and isinstance(df.schema[name].dataType, T.NumericType)


def check_row_count(legacy: DataFrame, new: DataFrame, tolerance: float = DEFAULT_TOLERANCE):
    return _profile_checks(
        legacy, new, None, [], [], Tolerances(row_count=tolerance), ["row_count"]
    )


def check_key_hash(legacy: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Order-free fingerprint of the key set: row count and the sum of key hashes."""
    return _profile_checks(legacy, new, key, [], [], Tolerances(), ["key_hash"])


def check_null_rates(legacy: DataFrame, new: DataFrame, tolerance: float = DEFAULT_TOLERANCE):
    """Absolute difference of the null share of every common column."""
    return _profile_checks(
        legacy,
        new,
        None,
        _common(legacy, new),
        [],
        Tolerances(null_rate=tolerance),
        ["null_rate"],
    )


def check_metrics(
    legacy: DataFrame, new: DataFrame, metrics: list[str], tolerance: float = DEFAULT_TOLERANCE
) -> DataFrame:
    """Relative difference of sum and mean, as decimal(18,2).

    A metric that a side lacks or holds as text fails, and so does one with a value too
    large for that type.
    """
    return _profile_checks(
        legacy, new, None, [], metrics, Tolerances(metric=tolerance), ["metric"]
    )


def check_schema(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """One row per column that either side has; order does not matter."""
    before = {f.name: f.dataType.simpleString() for f in legacy.schema.fields}
    after = {f.name: f.dataType.simpleString() for f in new.schema.fields}
    rows = [
        (name, before.get(name), after.get(name), before.get(name) == after.get(name))
        for name in sorted({*before, *after})
    ]
    return legacy.sparkSession.createDataFrame(
        rows, "column string, legacy_type string, new_type string, passed boolean"
    )


def key_hash_histogram(
    legacy: DataFrame, new: DataFrame, key: list[str], buckets: int = 64
) -> DataFrame:
    """Rows per key-hash bucket on both sides."""
    tagged = _both(
        legacy, new, lambda df: [F.pmod(key_hash(key), F.lit(buckets)).alias("bucket")]
    )
    return (
        tagged.groupBy("bucket")
        .agg(*_sides("n", F.count_if))
        .withColumn("passed", F.col("n_legacy") == F.col("n_new"))
    )


def check_key_histogram(
    legacy: DataFrame, new: DataFrame, key: list[str], buckets: int = 64
) -> DataFrame:
    """Number of filled key-hash buckets on each side, as a check row; delta counts those that differ."""
    bad = key_hash_histogram(legacy, new, key, buckets).agg(
        F.count_if(F.col("n_legacy") > 0).alias("filled_legacy"),
        F.count_if(F.col("n_new") > 0).alias("filled_new"),
        F.count_if(~F.col("passed")).alias("unequal"),
    )
    unequal = F.col("unequal")
    row = _check("key_hist", ",".join(key), F.col("filled_legacy"), F.col("filled_new"),
                 unequal.cast("double"), unequal == 0)
    return bad.select(F.inline(F.array(row)))


def duplicate_keys(legacy: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are null or occur more than once on a side, with the counts of both sides.

    A count per key with map-side partials, so a hot key costs one row per task.
    """
    tagged = _both(legacy, new, lambda df: [F.col(k) for k in key])
    no_key = reduce(lambda a, b: a | b, [F.isnull(k) for k in key])
    return (
        tagged.groupBy(*key)
        .agg(*_sides("n", F.count_if))
        .filter((F.col("n_legacy") > 1) | (F.col("n_new") > 1) | no_key)
    )


def check_unique_keys(legacy: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Number of keys that repeat on each side, as a check row."""
    repeated = duplicate_keys(legacy, new, key).agg(
        F.count_if(F.col("n_legacy") > 1).alias("legacy_keys"),
        F.count_if(F.col("n_new") > 1).alias("new_keys"),
    )
    pair = (F.col("legacy_keys"), F.col("new_keys"))
    worst = F.greatest(*pair)
    return repeated.select(
        F.inline(
            F.array(
                _check("key_unique", ",".join(key), *pair, worst.cast("double"), worst == 0)
            )
        )
    )


def reconcile(
    legacy: DataFrame,
    new: DataFrame,
    key: list[str],
    metrics: list[str],
    tolerances: Tolerances = Tolerances(),
) -> DataFrame:
    """Every check as rows."""
    schema = check_schema(legacy, new)
    number = T.DecimalType(38, 6)
    schema_rows = schema.select(
        F.lit("schema").alias("check_name"),
        F.col("column").alias("item"),
        F.lit(None).cast(number).alias("legacy"),
        F.lit(None).cast(number).alias("new"),
        F.when(F.col("passed"), 0.0).otherwise(1.0).alias("delta"),
        "passed",
    )
    profile = _profile_checks(
        legacy,
        new,
        key,
        _common(legacy, new),
        metrics,
        tolerances,
        ["row_count", "key_hash", "not_null", "null_rate", "metric"],
    )
    checks = [profile, check_key_histogram(legacy, new, key), check_unique_keys(legacy, new, key)]
    return reduce(DataFrame.unionByName, checks, schema_rows)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: passed only when every check passed."""
    return checks.agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.bool_and("passed").alias("passed"),
    )


HEAVY_SHARE = 10_000


def _by_weight(bad: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Repeated keys as (heavy, light).

    Heavy keys hold more than 1/10,000 of the repeated rows each, so there are
    fewer than 10,000 of them and broadcasting them is safe; what they leave to
    a shuffle has no hot key.
    """
    rows = F.col("n_legacy") + F.col("n_new")
    total = bad.agg(F.sum(rows).alias("n")).first()["n"] or 0
    limit = total // HEAVY_SHARE
    heavy = bad.filter(rows > limit).select(*key)
    return heavy, small_or_shuffled(bad.filter(rows <= limit).select(*key))


def _aligned(legacy: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with their common columns; those of different types as text."""
    common = _common(legacy, new)
    retyped = {c for c in common if legacy.schema[c].dataType != new.schema[c].dataType}

    def columns(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) if c in retyped else F.col(c) for c in common])

    return columns(legacy), columns(new), common


def _schema_rows(legacy: DataFrame, new: DataFrame, key: list[str], like: T.StructType) -> DataFrame:
    """Columns that only one side has, or that changed their type, in the form of a diff."""
    rows = []
    for row in check_schema(legacy, new).filter("not passed").collect():
        status = ("column_added" if row.legacy_type is None
                  else "column_dropped" if row.new_type is None else "column_retyped")
        rows.append((*[None] * len(key), status, row.column, 0, 0))
    return legacy.sparkSession.createDataFrame(rows, like)


def diff_rows(
    legacy: DataFrame, new: DataFrame, key: list[str], report_repeated: bool = True
) -> DataFrame:
    """Differences by key: only_legacy, only_new, changed (with column names), bad_key; and by
    column: column_added, column_dropped, column_retyped, with a null key.

    Digests find the buckets of keys in which the sides differ; only their rows are moved
    and compared. Keys that repeat or are null cannot be paired; they are reported once
    with their counts and kept out of the join, which would multiply them. To find those
    that repeat alike on both sides costs a count for each key; without `report_repeated`
    they are reported only where the sides differ. A retyped column is compared as text.
    """
    left, right, common = _aligned(legacy, new)
    compared = [c for c in common if c not in key]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    keys = [left.schema[k] for k in key]
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in keys])
    for name, kind in (("status", "string"), ("columns", "string"), ("n_legacy", "long"), ("n_new", "long")):
        shape = shape.add(name, kind)
    schema_rows = _schema_rows(legacy, new, key, shape)

    def unpaired(bad: DataFrame) -> DataFrame:
        return bad.select(*key, F.lit("bad_key").alias("status"), F.lit("").alias("columns"),
                          "n_legacy", "n_new")

    parts = differing_rows(left, right, key, compared)
    if parts is None:
        return schema_rows.unionByName(unpaired(duplicate_keys(left, right, key))) if report_repeated else schema_rows
    # Normally empty or short: found once, kept, and then of known size.
    bad = cut_lineage(duplicate_keys(*((left, right) if report_repeated else parts), key))
    heavy, light = _by_weight(bad.filter(whole), key)

    def clean(df: DataFrame, side: str) -> DataFrame:
        return (
            df.filter(whole)
            .join(F.broadcast(heavy), key, "left_anti")
            .join(light, key, "left_anti")
            .select(
                *key,
                F.lit(True).alias(f"_{side}"),
                *[F.col(c).alias(f"_{side}_{c}") for c in compared],
            )
        )

    changed = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"_legacy_{c}").eqNullSafe(F.col(f"_new_{c}")), F.lit(c))
                for c in sorted(compared)
            ]
        )
    )
    paired = clean(parts[0], "legacy").join(clean(parts[1], "new"), key, "full_outer")
    status = (
        F.when(F.isnull("_new"), F.lit("only_legacy"))
        .when(F.isnull("_legacy"), F.lit("only_new"))
        .when(F.size(changed) > 0, F.lit("changed"))
    )
    differences = paired.select(
        *key,
        status.alias("status"),
        F.when(status == "changed", F.array_join(changed, ",")).otherwise("").alias("columns"),
        F.when(F.col("_legacy"), 1).otherwise(0).cast("bigint").alias("n_legacy"),
        F.when(F.col("_new"), 1).otherwise(0).cast("bigint").alias("n_new"),
    ).filter(F.col("status").isNotNull())
    return differences.unionByName(unpaired(bad)).unionByName(schema_rows)


def cutover_ready(
    daily: DataFrame, min_days: int = 7, by: tuple[str, ...] = (), day: str = "day"
) -> DataFrame:
    """Unbroken runs of calendar days whose diffs were clean or explained.

    `daily(day, passed, explained)`, several rows a day allowed; a day counts
    when all its rows do. Rows are reduced to days before the window, so a
    window partition holds at most one row per calendar day.
    """
    good = F.col("passed") | F.coalesce("explained", F.lit(False))
    days = (
        daily.groupBy(*by, day).agg(F.bool_and(good).alias("_good")).filter("_good").drop("_good")
    )
    order = Window.partitionBy(*by).orderBy(day)
    return (
        days.withColumn("_run", F.date_sub(F.col(day), F.row_number().over(order)))
        .groupBy(*by, "_run")
        .agg(
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .drop("_run")
        .withColumn("ready", F.col("n_days") >= min_days)
    )
