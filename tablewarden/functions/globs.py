"""Patterns in a table: their regular expressions and literal factors, by built-in functions.

The same rules as in `patterns`, which serves patterns known to the driver. A pattern
covers a path in one of several ways; each way is a glob or a literal beginning, and has
factors: what all it covers begins with, ends with, or contains.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = r"\[!?\]?[^\]]*\]|(?s:.)"
_SET = r"\[!?\]?[^\]]*\]"


def quoted(literal: Column) -> Column:
    return F.regexp_replace(literal, "([^A-Za-z0-9_/ -])", r"\\$1")


def _token(token: Column) -> Column:
    negated = F.substring(token, 2, 1) == "!"
    body = F.substring(token, F.when(negated, 3).otherwise(2), F.length(token))
    body = F.substring(body, F.lit(1), F.length(body) - 1)
    body = F.regexp_replace(body, r"([\\\[\]^&])", r"\\$1")
    listed = F.concat(F.lit("["), F.when(negated, F.lit("^")).otherwise(F.lit("")), body, F.lit("]"))
    return (
        F.when(token == "*", F.lit(".*"))
        .when(token == "?", F.lit("."))
        .when((F.length(token) > 2) & F.startswith(token, F.lit("[")), listed)
        .otherwise(quoted(token))
    )


def glob_body(glob: Column) -> Column:
    """The regex of a glob, without anchors."""
    return F.array_join(F.transform(F.regexp_extract_all(glob, F.lit(_TOKEN), F.lit(0)), _token), "")


def _way(body: Column, glob: Column | None, head: Column | None = None) -> Column:
    """regex and factors of one way; a literal beginning has nothing but a head."""
    parts = F.split(F.regexp_replace(glob, _SET, "?"), r"[*?\[]") if glob is not None else None
    return F.struct(
        F.concat(F.lit("(?s)^(?:"), body, F.lit(")$")).alias("regex"),
        (F.get(parts, F.lit(0)) if parts is not None else head).alias("head"),
        (F.element_at(parts, -1) if parts is not None else F.lit("")).alias("tail"),
        (F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
         if parts is not None else F.lit("")).alias("middle"),
    )


def rule_ways(pattern: Column) -> Column:
    """All the ways in which `rule_regex` covers a path."""
    stem = F.regexp_replace(pattern, "[/*]+$", "")
    shorter = F.substring(pattern, F.lit(1), F.length(pattern) - 1)
    none = F.lit(None)
    way = _way(glob_body(pattern), pattern)
    return F.array_compact(F.array(
        way,
        _way(F.concat(quoted(stem), F.lit("(?:/.*)?")), None, stem),
        F.when(F.endswith(pattern, F.lit("/")), _way(glob_body(shorter), shorter)).otherwise(none),
        F.when(F.endswith(pattern, F.lit("*")), _way(F.concat(quoted(stem), F.lit(".*")), None, stem))
        .otherwise(none),
    ))


def coverage_ways(pattern: Column) -> Column:
    """The same for `coverage_regex`, whose subject is `/path/`."""
    rooted = F.when(F.startswith(pattern, F.lit("/")), pattern).otherwise(F.concat(F.lit("/"), pattern))
    last = F.element_at(F.split(rooted, "/"), -1)
    open_end = F.endswith(rooted, F.lit("/")) | F.contains(last, F.lit("*"))
    glob = F.when(open_end, rooted).otherwise(F.concat(rooted, F.lit("/")))
    begun, cut = F.concat(glob, F.lit("*")), F.substring(glob, F.lit(1), F.length(glob) - 1)
    ended = F.concat(glob_body(cut), F.lit("/"))
    # With the slash added as a literal, the factors are those of the cut glob and a slash.
    return F.array(_way(glob_body(begun), begun), _way(ended, F.concat(cut, F.lit("/"))))
