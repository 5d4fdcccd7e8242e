"""Quality rules with host verdicts. Built-in functions only.

Each document is measured by itself. Failures are then counted by host, the
rates are shrunk towards what hosts are like on the whole, and a host whose
shrunk rate of any rule is too high takes its documents with it. Below that, a
document that fails a rule goes unless its host fails the rule less than hosts do
on the whole.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, small_or_shuffled

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
HOST_LIMIT = 0.75
RULES = ("short", "repeats", "symbols", "dup_lines")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once, for use in nested functions of arrays."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window whose three words occur twice or more in the text."""

    def covered(positions: Column) -> Column:
        # Each window adds what the window before it has not covered.
        return F.aggregate(
            positions,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda s, p: F.struct(
                (s["n"] + F.least(F.lit(3), p - s["last"])).cast("long").alias("n"), p.alias("last")
            ),
            lambda s: s["n"],
        )

    def repeated(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, i: (
                ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]))
                | (F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)))
            ),
        )

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")
            ),
        )

    count = let(
        words,
        lambda w: let(
            F.array_sort(windows(w)),
            lambda ordered: covered(F.array_sort(F.transform(repeated(ordered), lambda x: x["i"]))),
        ),
    )
    return F.when(F.size(words) >= 4, count).otherwise(F.lit(0).cast("long"))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The counts of a text (not null) and its array of words."""
    lines = F.filter(
        F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0
    )
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(words),
    }


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with a struct `q` of counts and of the rules that a document fails."""
    body = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(body, f"[{SPACES}]+"), lambda w: F.length(w) > 0)
    counted = docs.withColumn(
        "q",
        let(F.struct(body.alias("t"), words.alias("w")),
            lambda x: F.struct(*(c.alias(n) for n, c in measures(x["t"], x["w"]).items()))),
    )
    q = F.col("q")
    fails = {
        "short": q.n_words < MIN_WORDS,
        "repeats": 100 * q.n_repeat_words > MAX_REPEAT_PERCENT * q.n_words,
        "symbols": 100 * q.n_symbols > MAX_SYMBOL_PERCENT * q.word_chars,
        "dup_lines": 100 * q.n_dup_lines > MAX_DUP_LINE_PERCENT * q.n_lines,
    }
    return counted.withColumns({f"f_{rule}": failed for rule, failed in fails.items()})


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """host, rule, n, failed and the shrunk rate. Null is a host of its own.

    The prior of a rule is a beta distribution fitted to the hosts' failures by moments,
    hosts weighted by their documents: its mean is the share of all documents that fail,
    its spread what hosts differ by beyond the chance of counting in few documents. A host
    with few documents stays near the mean; a large one is judged by its own rate. Where
    hosts differ by no more than chance, the prior weighs as much as all documents. With
    fewer than two hosts, or rates that differ more than a beta allows, it weighs one.
    """
    counts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"),
        *(F.sum(F.col(f"f_{rule}").cast("long")).alias(rule) for rule in RULES),
    )
    tall = cut_lineage(
        counts.select(
            "host", "n",
            F.explode(
                F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in RULES))
            ).alias("x"),
        ).select("host", "n", "x.*")
    )
    n, failed = F.col("n"), F.col("failed")
    prior = tall.groupBy("rule").agg(
        (F.sum("failed") / F.sum("n")).alias("mean"), F.sum("n").cast("double").alias("total"),
        (F.count("*") - 1).alias("others"), F.sum(n * n / 1.0).alias("squares"),
        F.sum(failed * failed / n).alias("rates"),
    )
    # How alike two documents of a host are, from the weighted sum of squares between hosts.
    mean, total, others = F.col("mean"), F.col("total"), F.col("others")
    between = F.col("rates") - total * mean * mean
    room = total - F.col("squares") / total - others
    alike = F.when((mean > 0) & (mean < 1) & (room > 0),
                   (between / (mean * (1 - mean)) - others) / room).otherwise(0.0)
    weight = (
        F.when((others == 0) | (alike >= 1), 1.0).when(alike <= 0, total)
        .otherwise(F.least(1 / alike - 1, total))
    )
    return tall.join(F.broadcast(prior), "rule").select(
        "host", "rule", "n", "failed",
        ((F.col("failed") + F.col("mean") * weight) / (F.col("n") + weight)).alias("rate"),
        F.col("mean").alias("prior"),
    )


def host_verdicts(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """host -> host_rejected: whether the shrunk rate of any rule is above the limit,
    and for each rule whether its shrunk rate is not below the prior.
    """
    # A host that is like the prior must not fall to either side by rounding.
    bad = F.col("rate") * (1 + 1e-9) >= F.col("prior")
    return host_rates(measured, host).groupBy("host").agg(
        (F.max("rate") > limit).alias("host_rejected"),
        *(F.max((F.col("rule") == rule) & bad).alias(f"bad_{rule}") for rule in RULES),
    )


def with_verdicts(facts: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Materialised `measured` rows with base_failed, host_rejected and kept.

    host_rejected is the host's verdict on the document: all of a host beyond the limit
    go, else those that fail a rule in which the host is not better than the prior.
    """
    verdicts = small_or_shuffled(cut_lineage(host_verdicts(facts, host, limit)))
    joined = facts.join(verdicts, facts[host].eqNullSafe(verdicts.host), "left")
    return joined.select(
        *(facts[c] for c in facts.columns),
        (F.col("f_short") | F.col("f_repeats")).alias("base_failed"),
        reduce(or_, (F.col(f"f_{rule}") & F.col(f"bad_{rule}") for rule in RULES),
               F.col("host_rejected")).alias("host_rejected"),
    ).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def score_quality(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Counts and verdict of each document. Only the counts are written between the two passes.

    A null or empty text has no words and fails as short. Each row is judged by itself, so
    repeated rows have one row each. Rows without a source are one host.
    """
    facts = cut_lineage(
        measured(docs).select("doc_id", "source", "q", *(f"f_{rule}" for rule in RULES))
    )
    return with_verdicts(facts, limit=limit).select(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
        "base_failed", "host_rejected", "kept",
    )


def filter_quality(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that are kept, with their columns as they were.

    The measured rows are written with all columns, so that repeated ids need no join.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                        "text", "source")
    facts = cut_lineage(measured(whole).drop("text", "q"))
    return with_verdicts(facts, limit=limit).where("kept").select("doc.*")
