"""Ordered ownership rules over paths, and the inventory built on them.

Rules are (ord, pattern, owners). Up to `MAX_INLINE` of them become one CASE
expression, evaluated where the paths are scanned: no join, no shuffle. Longer
rule tables are joined on what patterns literally begin with, end with or contain.
Of rules with one `ord`, as in merged files, the greater pattern counts as the later.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, lookup_join, small_or_shuffled
from tablewarden.functions.containment import contained_words
from tablewarden.functions.globs import coverage_ways, rule_ways
from tablewarden.functions.patterns import coverage_regex, matches, rule_regex
from tablewarden.functions.text import extract_all, strip
from tablewarden.operators.ordered import first_n

MAX_INLINE = 200
CATCH_ALL = "*"
SALTS = 32

# What to do about a folder, in report order.
CREATE_FOLDER = "create_folder"
ASSIGN_OWNER = "assign_owner"
ADD_TO_CATALOGUE = "add_to_catalogue"
ADD_GUIDE = "add_guide"
SECTIONS = ("apps", "libs", "dbt")


@dataclass(frozen=True)
class Rule:
    pattern: str
    owners: tuple[str, ...]


def parse_rules(lines: DataFrame, inline_comments: bool = False) -> DataFrame:
    """Rule lines (ord, line) to (ord, pattern, owners). Comments and bare patterns are dropped.

    With `inline_comments` a `#` ends the line anywhere and only words that
    start with `@` are owners, as the reference check reads them; the pattern
    then keeps its leading slash.
    """
    line = F.col("line")
    if inline_comments:
        line = F.get(F.split(line, "#"), F.lit(0))
    words = F.split(strip(line), r"\s+")
    parsed = lines.select("ord", strip(line).alias("_line"), words.alias("_words")).filter(
        (F.col("_line") != "") & ~F.startswith("_line", F.lit("#")) & (F.size("_words") >= 2)
    )
    owners = F.slice("_words", F.lit(2), F.size("_words"))
    pattern = F.get("_words", F.lit(0))
    if inline_comments:
        owners = F.filter(owners, lambda w: F.startswith(w, F.lit("@")))
    else:
        pattern = F.regexp_replace(pattern, "^/+", "")
    return parsed.select("ord", pattern.alias("pattern"), owners.alias("owners"))


def flatten_distinct(rules: DataFrame) -> DataFrame:
    """Every owner any rule names."""
    return rules.select(F.explode("owners").alias("owner")).distinct()


def collect_rules(rules: DataFrame, max_rules: int = MAX_INLINE) -> list[Rule] | None:
    """The rules in order, or None when there are too many to inline."""
    rows = rules.orderBy("ord", "pattern", "owners").limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        return None
    return [Rule(r["pattern"], tuple(r["owners"])) for r in rows]


def rule_number(path: Column, rules: list[Rule]) -> Column:
    """Index of the last rule that covers the path; null without one."""
    cases = None
    for i in reversed(range(len(rules))):
        hit = matches(path, rule_regex(rules[i].pattern))
        cases = F.when(hit, F.lit(i)) if cases is None else cases.when(hit, F.lit(i))
    return F.lit(None).cast("int") if cases is None else cases


def _inline(rules: list[Rule] | DataFrame, max_inline: int) -> list[Rule] | None:
    return rules if isinstance(rules, list) else collect_rules(rules, max_inline)


def last_match(
    df: DataFrame,
    path: str,
    rules: list[Rule] | DataFrame,
    default: str = "@platform-team",
    max_inline: int = MAX_INLINE,
) -> DataFrame:
    """Add `pattern` and `owners` of the last covering rule, `*` and the default without one."""
    inline = _inline(rules, max_inline)
    if inline is not None:
        if not inline:
            return df.withColumns(
                {"pattern": F.lit(CATCH_ALL), "owners": F.array(F.lit(default))}
            )
        i = F.col("_rule")
        patterns = F.array(*[F.lit(r.pattern) for r in inline])
        owners = F.array(*[F.array(*[F.lit(o) for o in r.owners]) for r in inline])
        return (
            df.withColumn("_rule", rule_number(F.col(path), inline))
            .withColumns(
                {
                    "pattern": F.coalesce(F.get(patterns, i), F.lit(CATCH_ALL)),
                    "owners": F.coalesce(F.get(owners, i), F.array(F.lit(default))),
                }
            )
            .drop("_rule")
        )
    winners = covering_rule(df, path, rules).drop("ord")
    return lookup_join(df, winners, [path], "left").select(
        *df.columns,
        F.coalesce("pattern", F.lit(CATCH_ALL)).alias("pattern"),
        F.coalesce("owners", F.array(F.lit(default))).alias("owners"),
    )


@dataclass(frozen=True)
class Matcher:
    """How a pattern is compared with a path: inline, or by the ways of a pattern in a table."""

    subject: Callable[[Column], Column]
    regex: Callable[[str], str]
    ways: Callable[[Column], Column]


LENIENT = Matcher(lambda path: path, rule_regex, rule_ways)
STRICT = Matcher(
    lambda path: F.concat(F.lit("/"), F.regexp_replace(path, "^/+|/+$", ""), F.lit("/")),
    coverage_regex,
    coverage_ways,
)


def _sizes(ways: DataFrame, side: str) -> list[int]:
    """Lengths of the factors of one side: at most as many as the longest has characters."""
    sized = ways.filter(F.col("side") == side).select(F.length("factor").alias("n")).distinct()
    return sorted(r["n"] for r in sized.collect())


def covering_rule(
    paths: DataFrame, path: str, rules: DataFrame, matcher: Matcher = LENIENT
) -> DataFrame:
    """(path, ord, pattern, owners) of the last covering rule of each distinct path, for rule
    tables of any length; one row a path, also where rules share an `ord`.

    Each way of a pattern is found by its longest literal factor: paths are equi-joined on
    their beginnings and on their reversed endings, of the lengths that factors have, and
    factors from the middle are looked up by what paths contain. Only such pairs are
    matched. Patterns without any literal meet every path; both sides carry a salt for them.
    """
    last = rules.groupBy("pattern").agg(F.max(F.struct("ord", "owners")).alias("rule"))
    way = F.col("way")
    longest = F.greatest(F.length(way.head), F.length(way.tail), F.length(way.middle))
    ways = cut_lineage(
        last.select("pattern", "rule", F.explode(matcher.ways(F.col("pattern"))).alias("way")).select(
            F.struct("rule.ord", "pattern", "rule.owners").alias("rule"),
            way.regex.alias("regex"),
            F.when(longest == 0, "any").when(F.length(way.head) == longest, "head")
            .when(F.length(way.tail) == longest, "tail").otherwise("middle").alias("side"),
            F.when(F.length(way.head) == longest, way.head)
            .when(F.length(way.tail) == longest, F.reverse(way.tail))
            .otherwise(way.middle).alias("factor"),
        )
    )
    subject = F.col("_subject")
    asked = paths.select(path).distinct().withColumn("_subject", matcher.subject(F.col(path)))

    def cuts(text: Column, side: str) -> Column:
        sizes = _sizes(ways, side)
        taken = [F.when(F.length(text) >= n, F.struct(F.lit(side).alias("side"), F.left(text, F.lit(n)).alias("factor")))
                 for n in sizes]
        return F.array_compact(F.array(*taken)) if taken else F.array()

    nothing = F.array(F.struct(F.lit("any").alias("side"), F.lit("").alias("factor")))
    factors = F.concat(nothing, cuts(subject, "head"), cuts(F.reverse(subject), "tail"))
    probes = asked.select(path, "_subject", F.explode(factors).alias("_f")).select(path, "_subject", "_f.*")
    middles = ways.filter("side = 'middle'").select("factor").distinct()
    holding = contained_words(asked.withColumn("_text", subject), "_text", middles, "factor")
    probes = probes.unionByName(holding.select(path, "_subject", F.lit("middle").alias("side"), "factor"))
    bare = F.col("side") == "any"
    salted = ways.withColumn(
        "salt",
        F.explode(
            F.when(bare, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return (
        probes.withColumn(
            "salt",
            F.when(bare, F.pmod(F.xxhash64(path), F.lit(SALTS)).cast("int")).otherwise(0),
        )
        .join(small_or_shuffled(salted), ["side", "factor", "salt"])
        .filter(F.rlike(subject, F.col("regex")))
        .groupBy(path)
        .agg(F.max("rule").alias("rule"))
        .select(path, "rule.ord", "rule.pattern", "rule.owners")
    )


def has_explicit_rule(path: Column, rules: list[Rule], matcher: Matcher = LENIENT) -> Column:
    """Some rule other than the catch-all covers the path."""
    hits = [
        matches(matcher.subject(path), matcher.regex(r.pattern))
        for r in rules
        if r.pattern != CATCH_ALL
    ]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def flag_explicit(
    df: DataFrame,
    path: str,
    rules: list[Rule] | DataFrame,
    flag: str = "in_rules",
    matcher: Matcher = LENIENT,
    max_inline: int = MAX_INLINE,
) -> DataFrame:
    """Add whether some rule other than the catch-all covers the path."""
    inline = _inline(rules, max_inline)
    if inline is not None:
        return df.withColumn(flag, has_explicit_rule(F.col(path), inline, matcher))
    named = rules.filter(F.col("pattern") != CATCH_ALL)
    covered = covering_rule(df, path, named, matcher).select(path, F.lit(True).alias(flag))
    return lookup_join(df, covered, [path], "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )


def uncovered(
    df: DataFrame,
    path: str,
    rules: list[Rule] | DataFrame,
    matcher: Matcher = STRICT,
    max_inline: int = MAX_INLINE,
) -> DataFrame:
    """Rows whose path no rule but the catch-all covers."""
    flagged = flag_explicit(df, path, rules, "_covered", matcher, max_inline)
    return flagged.filter("NOT _covered").drop("_covered")


def mentions(corpus: DataFrame, pattern: str, path: str = "path", text: str = "text") -> DataFrame:
    """Distinct (name, path) for every match of `pattern` in a text."""
    return corpus.select(
        F.explode(F.array_distinct(extract_all(F.col(text), pattern))).alias("name"),
        F.col(path).alias("path"),
    ).distinct()


def reference_check(
    refs: DataFrame, declared: DataFrame, allowed: list[str], n_examples: int = 3
) -> DataFrame:
    """Names used but not declared (error), declared but neither used nor allowed (warning).

    `refs(name, path)` may repeat; `declared(name)`. Counts are merged per name
    in one aggregation; only errors carry examples, the first few paths.
    """
    used = refs.distinct()
    names = (
        used.groupBy("name")
        .agg(F.count(F.lit(1)).alias("n_paths"))
        .withColumn("_declared", F.lit(False))
        .unionByName(
            declared.select("name").select(
                "name", F.lit(0).cast("bigint").alias("n_paths"), F.lit(True).alias("_declared")
            )
        )
        .groupBy("name")
        .agg(F.sum("n_paths").alias("n_paths"), F.bool_or("_declared").alias("_declared"))
    )
    missing = (F.col("n_paths") > 0) & ~F.col("_declared")
    unused = (F.col("n_paths") == 0) & ~F.col("name").isin(*allowed)
    findings = names.select(
        "name",
        "n_paths",
        F.when(missing, F.lit("error")).when(unused, F.lit("warning")).alias("level"),
    ).filter(F.col("level").isNotNull())
    shown = (
        first_n(used, ["name"], ["path"], n_examples)
        .groupBy("name")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("position", "path"))), lambda s: s["path"]
                ),
                ", ",
            ).alias("examples")
        )
    )
    return findings.join(shown, "name", "left").withColumn(
        "examples", F.coalesce("examples", F.lit(""))
    )


def stale(entries: DataFrame, actual: DataFrame, key: str, source: str, reason: str) -> DataFrame:
    """Entries that name nothing real."""
    real = actual.select(key).distinct()
    return entries.select(key).distinct().join(real, key, "left_anti").select(
        F.lit(source).alias("source"), F.col(key).alias("entry"), F.lit(reason).alias("reason")
    )


def inventory(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """Every key of any set once, with a flag per set."""
    tagged = [
        df.select(key, *[F.lit(name == other).alias(other) for other in sets])
        for name, df in sets.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(key)
        .agg(*[F.bool_or(name).alias(name) for name in sets])
    )


def specific_entries(patterns: Column) -> Column:
    """The folder a pattern names, when it has no wildcard and lies in a known section; else null."""
    entry = F.regexp_replace(patterns, "/+$", "")
    return F.when(entry.rlike(f"^(?:{'|'.join(SECTIONS)})/[^*?]*$"), entry)


def _named_folders(spark: SparkSession, rules: list[Rule] | DataFrame) -> DataFrame:
    if isinstance(rules, list):
        rules = spark.createDataFrame([(r.pattern,) for r in rules], "pattern string")
    return rules.select(specific_entries(F.col("pattern")).alias("path")).dropna()


def actions(path: Column, exists: Column, ruled: Column, catalogued: Column, guided: Column):
    """What has to be done about a folder, in report order."""
    return F.array_compact(
        F.array(
            F.when(~exists, F.lit(CREATE_FOLDER)),
            F.when(~ruled, F.lit(ASSIGN_OWNER)),
            F.when(F.startswith(path, F.lit("apps/")) & ~catalogued, F.lit(ADD_TO_CATALOGUE)),
            F.when(exists & ~guided, F.lit(ADD_GUIDE)),
        )
    )


def folder_status(
    on_disk: DataFrame,
    catalogue: DataFrame,
    guides: DataFrame,
    rules: list[Rule] | DataFrame,
    default: str = "@platform-team",
) -> DataFrame:
    """One row per folder known to any source: flags, owner and actions. Each frame has `path`."""
    named = _named_folders(on_disk.sparkSession, rules)
    known = inventory(
        {
            "folder_exists": on_disk,
            "in_catalogue": catalogue,
            "has_guide": guides.select("path").distinct().join(on_disk.select("path").distinct(), "path", "left_semi"),
            "named_by_rule": named,
        },
        "path",
    ).drop("named_by_rule")
    owned = flag_explicit(last_match(known, "path", rules, default), "path", rules)
    flags = [F.col(c) for c in ("folder_exists", "in_rules", "in_catalogue", "has_guide")]
    return owned.withColumn("actions", actions(F.col("path"), *flags))


def _counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size("actions") == 0).alias("healthy"),
        F.count_if(F.size("actions") > 0).alias("issues"),
    ]


def section_summary(status: DataFrame, sections=SECTIONS) -> DataFrame:
    """Totals per section, empty ones included, and a TOTAL row."""
    section = F.get(F.split("path", "/"), F.lit(0))
    counted = status.groupBy(section.alias("section")).agg(*_counts())
    zero = F.lit(0).cast("bigint")
    empty = status.sparkSession.createDataFrame(
        [(s,) for s in sections], "section string"
    ).select("section", zero.alias("total"), zero.alias("healthy"), zero.alias("issues"))
    return (
        counted.unionByName(empty)
        .rollup("section")
        .agg(F.sum("total").alias("total"), F.sum("healthy").alias("healthy"), F.sum("issues").alias("issues"))
        .withColumn("section", F.coalesce("section", F.lit("TOTAL")))
    )


def owner_summary(status: DataFrame) -> DataFrame:
    """Counts per owner set. The members come from `owner_members`."""
    return status.groupBy(F.array_join("owners", ", ").alias("owner")).agg(*_counts())


def owner_members(status: DataFrame) -> DataFrame:
    """The folders of each owner set, one per row, so no owner's list has to fit in memory."""
    return status.select(F.array_join("owners", ", ").alias("owner"), "path")


def required_actions(status: DataFrame) -> DataFrame:
    """One row per folder and action, numbered in report order."""
    return status.select(
        "path",
        F.array_join("owners", ", ").alias("owner"),
        F.posexplode("actions").alias("position", "action"),
    )


def overall_status(status: DataFrame, stale_entries: DataFrame) -> DataFrame:
    """One row: counts, and PASS only without issues and without stale entries."""
    issue = F.when(F.size("actions") > 0, 1).otherwise(0)
    tagged = status.select(
        F.lit(1).alias("folder"), issue.alias("issue"), F.lit(0).alias("stale")
    ).unionByName(
        stale_entries.select(
            F.lit(0).alias("folder"), F.lit(0).alias("issue"), F.lit(1).alias("stale")
        )
    )
    return tagged.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in
          (("folder", "folders"), ("issue", "issues"), ("stale", "stale"))]
    ).withColumn(
        "status",
        F.when((F.col("issues") == 0) & (F.col("stale") == 0), F.lit("PASS")).otherwise(
            "NEEDS ATTENTION"
        ),
    )


def examples(df: DataFrame, key: str, item: str, n: int = 3) -> DataFrame:
    """The first `n` distinct items per key (one row each) with the number of distinct items."""
    items = df.select(key, item).distinct()
    counts = items.groupBy(key).agg(F.count(F.lit(1)).alias("n_items"))
    return first_n(items, [key], [item], n).join(counts, key)
