"""Links between sets that overlap enough, found by T-occurrence search.

Sets meet in inverted lists. Rare items have short lists, which are merged: sets
that meet in one are candidates. Long lists are never merged. Candidates are
probed in them by binary search, since the items of a set are kept sorted. Only
sets made up nearly of frequent items can meet in long lists alone; these are
searched in blocks, where each query merges its short lists and probes its long
ones (DivideSkip).

Inside a list nothing needs all pairs: links only have to connect what belongs
together. Each set is tried against the least of its list first. Pairs within one
component need no further test; all pairs across components get one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewarden.context import cut_lineage, lookup_join, ship_package, small_or_shuffled
from tablewarden.llm.components import connected_components
from tablewarden.llm.tables import map_batches

SHORT_LIST = 64
BLOCK_SETS = 256
#: Pairs, or sets, that a task holds as Python objects at once.
PAIRS_AT_ONCE = 500
#: How many long lists a query sets aside grows as this weight shrinks.
PROBE_WEIGHT = 0.05

#: nodes -> (node, items): the sorted items of each node as little-endian 64-bit integers.
ItemsOf = Callable[[DataFrame], DataFrame]


def needed(n: int, m: int, percent: int) -> int:
    """The least overlap of sets of n and m items with Jaccard of `percent` or more."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: np.ndarray | int, percent: int):
    """Of so many first items in a common order, two similar sets must share one."""
    return n - -(-n * percent // 100) + 1


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def probe(items: np.ndarray, others: np.ndarray) -> int:
    """The overlap of two sorted sets by binary search of the smaller in the larger."""
    if len(items) > len(others):
        items, others = others, items
    at = np.searchsorted(others, items)
    at[at == len(others)] = 0
    return int((others[at] == items).sum()) if len(others) else 0


def verified(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The (a, b) pairs whose sets are similar enough."""
    own = items.select(F.col("node").alias("a"), F.col("items").alias("x"))
    other = items.select(F.col("node").alias("b"), F.col("items").alias("y"))

    def make():
        def step(batch):
            out: dict[str, list] = {"a": [], "b": []}
            for begin in range(0, batch.num_rows, PAIRS_AT_ONCE):
                part = batch.slice(begin, PAIRS_AT_ONCE)
                for a, b, x, y in zip(*(c.to_pylist() for c in part.columns)):
                    u, v = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                    common = probe(u, v)
                    if common and 100 * common >= percent * (len(u) + len(v) - common):
                        out["a"].append(a)
                        out["b"].append(b)
            return out
        return step

    return map_batches(
        pairs.join(own, "a").join(other, "b").select("a", "b", "x", "y"), "a long, b long", make
    )


def divide_skip(sets: list[np.ndarray], components: np.ndarray, percent: int,
                first: int | None = None) -> list[tuple[int, int]]:
    """Links among the sets that connect different components, each found one once.

    With `first`, only pairs of one of the first `first` sets and one of the others.
    """
    if not sets:
        return []
    items, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(inverse, kind="stable")
    lists = np.split(owner[order], np.cumsum(np.bincount(inverse, minlength=len(items)))[:-1])
    lengths = np.array([len(x) for x in lists])
    cuts = np.cumsum([0, *(len(s) for s in sets)])
    label = components.copy()
    links = []
    queries = range(len(sets)) if first is None else range(first)
    for q in queries:
        n = len(sets[q])
        least = -(-percent * n // 100)  # any similar set shares so many items
        mine = inverse[cuts[q] : cuts[q + 1]]
        mine = mine[np.argsort(lengths[mine], kind="stable")]
        longest = max(2, int(lengths[mine[-1]]))
        aside = min(least - 1, int(least / (PROBE_WEIGHT * np.log2(longest) + 1)))
        short, long = mine[: n - aside], mine[n - aside :]
        # The merge of the short lists: how often each set stands in them.
        counts = np.bincount(np.concatenate([lists[i] for i in short]), minlength=len(sets))
        found = np.flatnonzero(counts >= max(1, least - aside))
        if first is not None:
            found = found[found >= first]
        else:
            found = found[found > q]
        asked = np.sort(items[long])
        for c in found.tolist():
            if label[c] == label[q]:
                continue
            m = len(sets[c])
            if 100 * min(n, m) < percent * max(n, m):
                continue
            if counts[c] + probe(asked, sets[c]) >= needed(n, m, percent):
                links.append((q, c))
                label[label == label[c]] = label[q]
    return links


def _block_links(pools: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Links within pools (pool, node, c), by search of blocks against blocks."""
    counted = pools.groupBy("pool").agg(F.ceil(F.count("*") / F.lit(BLOCK_SETS)).cast("int").alias("k"))
    dealt = (
        pools.join(counted, "pool").join(items, "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("pool", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") <= F.col("other")).alias("left"), "node", "c", "items")
    )

    def search(block: pd.DataFrame) -> pd.DataFrame:
        same = block["i"].iat[0] == block["j"].iat[0]
        block = block.sort_values(["left", "node"], ascending=[False, True], kind="stable")
        sets = [np.frombuffer(x, "<u8") for x in block["items"]]
        found = divide_skip(sets, block["c"].to_numpy(), percent,
                            None if same else int(block["left"].sum()))
        nodes = block["node"].to_numpy()
        return pd.DataFrame({"a": [nodes[q] for q, _ in found], "b": [nodes[c] for _, c in found]},
                            dtype="int64")

    return dealt.groupBy("pool", "i", "j").applyInPandas(search, "a long, b long")


def _shared_enough(n: Column, m: Column, c: Column, percent: int) -> Column:
    """Whether c common items of two prefixes leave room for the overlap that is needed.

    All common items up to the end of the prefix that ends first are counted, and
    what follows it in that set cannot be more than its rest.
    """
    def rest(x: Column) -> Column:
        return F.ceil(x * percent / 100) - 1

    least = F.ceil(percent * (n + m) / (100 + percent))
    return c + F.greatest(rest(n), rest(m)) >= least


def _rarest_first(nodes: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(g, node, n): the first items of each node's set, those in the fewest of these sets first.

    An item of one set only takes its place in the order, but needs no list.
    """

    def make():
        def step(batch):
            for begin in range(0, batch.num_rows, PAIRS_AT_ONCE):
                part = batch.slice(begin, PAIRS_AT_ONCE)
                found = [np.frombuffer(x, "<i8") for x in part.column(1).to_pylist()]
                yield {"node": part.column(0), "items": found}
        return step

    asked = items.join(small_or_shuffled(nodes.select("node")), "node", "left_semi")
    rows = cut_lineage(
        map_batches(asked.dropDuplicates(["node"]).select("node", "items"),
                    "node long, items array<long>", make)
        .select("node", F.size("items").cast("long").alias("n"), F.explode("items").alias("g"))
    )
    often = rows.groupBy("g").agg(F.count("*").alias("df")).where("df > 1")
    ordered = lookup_join(rows, often, ["g"], "inner").groupBy("node").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "g"))).alias("x")
    )
    length = (F.size("x") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    return (
        ordered.withColumn("length", length).where("length > 0")
        .select("node", "n", F.explode(F.slice("x", F.lit(1), F.col("length"))).alias("y"))
        .select("y.g", "node", "n")
    )


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes are not in one component."""
    x = labels.select(F.col("node").alias("a"), F.col("component").alias("ac"))
    y = labels.select(F.col("node").alias("b"), F.col("component").alias("bc"))
    return (
        pairs.join(x, "a", "left").join(y, "b", "left")
        .where(F.coalesce("ac", "a") != F.coalesce("bc", "b")).select("a", "b")
    )


def _met(members: DataFrame) -> DataFrame:
    """The members (g, node, n) of lists of two nodes or more, with the least node of the list.

    Members are moved once, whatever their number, and nothing is broadcast: most lists
    have one node, so the others could not be looked up without moving all members again.
    """
    whole = Window.partitionBy("g")
    return (
        members.select(
            "g", "node", "n", F.min(F.struct("node", "n")).over(whole).alias("low"),
            F.max("node").over(whole).alias("high"),
        )
        .where(F.col("low.node") < F.col("high"))
        .select("g", "node", "n", F.col("low.node").alias("pivot"), F.col("low.n").alias("pivot_n"))
        .distinct()
    )


def _links(members: DataFrame, items_of: ItemsOf, percent: int, prefixes: bool, short_list: int,
           known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that connect what shares a list and is similar, the known ones included.

    Without known links this is the first pass, which leaves long lists to a second.
    """
    shared = cut_lineage(_met(members))

    def enough(pairs: DataFrame) -> DataFrame:
        counted = pairs.groupBy("a", "b").agg(
            F.first("an").alias("an"), F.first("bn").alias("bn"), F.count("*").alias("common")
        )
        if prefixes:
            counted = counted.where(
                _shared_enough(F.col("an"), F.col("bn"), F.col("common"), percent)
            )
        return counted.select("a", "b")

    stars = enough(
        shared.where("node <> pivot")
        .where(_sizes_allow(F.col("n"), F.col("pivot_n"), percent))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"),
                F.col("pivot_n").alias("an"), F.col("n").alias("bn"))
    )
    if known is not None:
        stars = _across(stars, connected_components(known))
    stars = cut_lineage(stars)
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    links = verified(stars, cut_lineage(items_of(cut_lineage(ends))), percent)
    links = cut_lineage(links if known is None else links.unionByName(known))
    labels = connected_components(links)

    # Lists whose members are not yet all connected, beyond the pairs tried above.
    open_members = (
        shared.join(labels, "node", "left")
        .withColumn("c", F.coalesce("component", "node")).drop("component")
    )
    open_lists = (
        open_members.groupBy("g")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("df"))
        .where("low < high").select("g", "df")
    )
    rest = cut_lineage(open_members.join(open_lists, "g"))

    # A pair that also meets in a long list is found there too.
    short = rest.where(F.col("df") <= short_list)
    x = short.select("g", F.col("node").alias("a"), F.col("n").alias("an"), F.col("c").alias("ac"))
    y = short.select("g", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("c").alias("bc"))
    pairs = enough(
        x.join(y, "g").where("a < b and ac <> bc")
        .where(_sizes_allow(F.col("an"), F.col("bn"), percent))
    )
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = cut_lineage(pairs.join(tried, ["a", "b"], "left_anti"))

    long = rest.where(F.col("df") > short_list)
    nodes = cut_lineage(long.select("node", "c").distinct())
    ends = (
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(nodes.select("node"))
    ).distinct()
    items = cut_lineage(items_of(cut_lineage(ends)))
    links = links.unionByName(cut_lineage(verified(pairs, items, percent)))
    if nodes.isEmpty():
        return links
    if known is None:
        return _links(
            cut_lineage(_rarest_first(nodes, items, percent)),
            lambda asked: items.join(small_or_shuffled(asked), "node", "left_semi"),
            percent, True, max(short_list, SHORT_LIST), links,
        )
    pool_of = connected_components(
        long.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    )
    pools = cut_lineage(
        nodes.join(pool_of, "node").select(F.col("component").alias("pool"), "node", "c")
    )
    return links.unionByName(cut_lineage(_block_links(pools, items, percent)))


def link_lists(members: DataFrame, items_of: ItemsOf, percent: int = 75, prefixes: bool = False,
               short_list: int = SHORT_LIST) -> DataFrame:
    """(g, node, n) memberships in inverted lists -> (node, component) by links.

    With `prefixes`, the lists hold the first items of each set in a common order,
    and candidates must share as many as similar sets do (T-occurrence).

    Two nodes are linked when they share a list and their sets have a Jaccard of
    `percent` or more; n is the size of a node's set. Repeated memberships do no
    harm. The components are exact for all pairs that share a list. `members` is
    read once.
    """
    ship_package(members.sparkSession)
    return connected_components(_links(members, items_of, percent, prefixes, short_list))
