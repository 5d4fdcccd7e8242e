"""Text helpers shared by lineage, rules and corpus jobs. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Single characters that end a line (CR LF together end one), and white space.
LINE_ENDS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
WHITE_SPACE = " \t\n\x1f\xa0\u1680\u202f\u205f\u3000" + LINE_ENDS + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


def extract_all(col: Column, pattern: str) -> Column:
    """Every match of `pattern`, in order of appearance."""
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))


def source_label(col: Column) -> Column:
    """What the first parentheses hold; an empty string without any."""
    return F.regexp_extract(col, r"\(([^)]+)\)", 1)


def path_segment(col: Column, index: int) -> Column:
    """Zero-based segment of a slash path; null past its end."""
    return F.get(F.split(col, "/"), F.lit(index))


def package_name(col: Column) -> Column:
    return F.translate(col, "-", "_")


def lookup(map_col: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(map_col, key), default)


def audit_key(target: Column, ts: Column, bundle: Column, sha: Column) -> Column:
    """`<target>/<date>/<bundle>-<first 12 of sha>.json`."""
    return F.concat(
        target,
        F.lit("/"),
        F.to_date(F.to_utc_timestamp(ts, F.current_timezone())).cast("string"),
        F.lit("/"),
        bundle,
        F.lit("-"),
        F.substring(sha, 1, 12),
        F.lit(".json"),
    )


def lines(col: Column) -> Column:
    """The text as lines. A final line break opens no further line; empty text has none.

    Rare line ends are replaced only in texts that hold one, so the usual cost is
    one split on a plain character.
    """
    rare = reduce(lambda a, b: a | b, [F.contains(col, F.lit(c)) for c in LINE_ENDS])
    unified = F.translate(
        F.replace(col, F.lit("\r\n"), F.lit("\n")), LINE_ENDS, "\n" * len(LINE_ENDS)
    )
    parts = F.split(F.when(rare, unified).otherwise(col), "\n", -1)
    # The piece after a final break is empty, and so is all of an empty text.
    return bind(
        parts,
        lambda p: F.when(
            F.get(p, F.size(p) - 1) == "", F.slice(p, F.lit(1), F.size(p) - 1)
        ).otherwise(p),
    )


def bind(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITE_SPACE))
