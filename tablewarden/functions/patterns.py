"""Path globs as regular expressions.

`LIKE` is no substitute: `_` is an ordinary character in paths.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_QUOTED = re.compile(r"[^A-Za-z0-9_/ -]")


def quote(literal: str) -> str:
    """Escape for Java and RE2 alike."""
    return _QUOTED.sub(lambda m: "\\" + m.group(0), literal)


def glob_to_regex(glob: str) -> str:
    """Whole-string regex for a glob: `*` any run, also across `/`; `?` one; `[..]`, `[!..]` a set."""
    tokens = re.findall(r"\[!?\]?[^\]]*\]|.", glob, flags=re.DOTALL)
    out = []
    for token in tokens:
        if token == "*":
            out.append(".*")
        elif token == "?":
            out.append(".")
        elif len(token) > 2 and token[0] == "[":
            negate = token[1] == "!"
            body = token[2 if negate else 1 : -1].replace("\\", "\\\\").replace("[", "\\[")
            body = body.replace("]", "\\]").replace("^", "\\^").replace("&", "\\&")
            out.append(f"[{'^' if negate else ''}{body}]")
        else:
            out.append(quote(token))
    return "(?s)^(?:" + "".join(out) + ")$"


def _unanchored(glob: str) -> str:
    return glob_to_regex(glob)[len("(?s)^(?:") : -len(")$")]


def rule_regex(pattern: str) -> str:
    """All the ways an ownership pattern covers a path, as one regex.

    The glob may hit the path or the path with a trailing slash; the pattern
    without its trailing `/` and `*` may be the path itself or a folder above
    it; and a pattern ending in `*` is also a plain prefix.
    """
    stem = pattern.rstrip("/*")
    ways = [_unanchored(pattern), quote(stem) + "(?:/.*)?"]
    if pattern.endswith("/"):
        ways.append(_unanchored(pattern[:-1]))
    elif pattern.endswith("*"):
        ways.append(quote(stem) + ".*")
    return "(?s)^(?:" + "|".join(ways) + ")$"


def coverage_regex(pattern: str) -> str:
    """The stricter variant used for coverage: compared as `/path/`, case-sensitive, with prefixes.

    Besides, path and glob may agree without the last character of either.
    """
    glob = pattern if pattern.startswith("/") else "/" + pattern
    if not glob.endswith("/") and "*" not in glob.split("/")[-1]:
        glob += "/"
    ways = [_unanchored(glob), _unanchored(glob + "*"), _unanchored(glob[:-1]) + "/"]
    return "(?s)^(?:" + "|".join(ways) + ")$"


def matches(path: Column, regex: str) -> Column:
    return path.rlike(regex)
