from __future__ import annotations

import fnmatch
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tablewarden.functions.globs import coverage_ways, rule_ways
from tablewarden.functions.patterns import coverage_regex, glob_to_regex, rule_regex
from tablewarden.operators import rules
from tablewarden.operators.rules import Rule

RULES = [
    Rule("*", ("@platform",)),
    Rule("apps/fin-*/", ("@fin",)),
    Rule("libs/", ("@lib",)),
    Rule("libs/fin-common/", ("@fin", "@lib")),
    Rule("dbt/**/schema.yml", ("@gov",)),
    Rule("apps/fin-old*", ("@old",)),
]
PATHS = ["apps/fin-a", "apps/x", "libs/any", "libs/fin-common", "libs/fin-common/src/a.py",
         "dbt/core/schema.yml", "apps/fin-older", "libs", "README.md"]
WANT = ["@fin", "@platform", "@lib", "@fin @lib", "@fin @lib", "@gov", "@old", "@lib", "@platform"]

path_text = st.text(alphabet="ab/_-.", max_size=8)
glob_text = st.text(alphabet="ab/_*?.", min_size=1, max_size=8)


@given(glob_text, path_text)
@settings(max_examples=400, deadline=None)
def test_glob_agrees_with_the_standard_library(glob, path):
    assert bool(re.search(glob_to_regex(glob), path)) == fnmatch.fnmatchcase(path, glob)


@pytest.mark.parametrize("glob", ["[ab]x", "[!ab]x", "[]]x", "[a-c]*", "[x", "a.b", "a+b", "(a)", "a|b", "[!]a]x"])
def test_glob_sets(glob):
    for path in ("ax", "bx", "cx", "]x", "[x", "a.b", "aab", "a+b", "(a)", "a|b", "axyz", "!x"):
        assert bool(re.search(glob_to_regex(glob), path)) == fnmatch.fnmatchcase(path, glob), path


def as_table(spark, listed):
    return spark.createDataFrame(
        [(i, r.pattern, list(r.owners)) for i, r in enumerate(listed)],
        "ord int, pattern string, owners array<string>",
    )


def paths(spark, values=PATHS):
    return spark.createDataFrame([(i, p) for i, p in enumerate(values)], "i int, path string")


@pytest.mark.parametrize("form", ["inline", "table", "joined"])
def test_last_match_wins(spark, form):
    given_rules = RULES if form == "inline" else as_table(spark, RULES)
    limit = 2 if form == "joined" else 200
    found = rules.last_match(paths(spark), "path", given_rules, max_inline=limit).orderBy("i")
    assert [" ".join(r.owners) for r in found.collect()] == WANT


def test_last_match_default_and_repeated_patterns(spark):
    listed = [Rule("a/", ("@one",)), Rule("b/", ("@b",)), Rule("a/", ("@two",))]
    for form, limit in ((listed, 200), (as_table(spark, listed), 1)):
        found = rules.last_match(paths(spark, ["a/x", "c"]), "path", form, "@d", limit).orderBy("i")
        assert [(r.pattern, r.owners) for r in found.collect()] == [("a/", ["@two"]), ("*", ["@d"])]
    assert rules.last_match(paths(spark, ["c"]), "path", [], "@d").first().owners == ["@d"]


@pytest.mark.parametrize("matcher", [rules.LENIENT, rules.STRICT])
def test_uncovered_inline_and_joined_agree(spark, rows, matcher):
    inline = rows(rules.uncovered(paths(spark), "path", RULES, matcher))
    assert inline == rows(rules.uncovered(paths(spark), "path", as_table(spark, RULES), matcher, 1))
    assert (8, "README.md") in inline and (0, "apps/fin-a") not in inline


MANY = ["*", "**", "?", "[ab]*", "*.py", "*/tests/*", "a/*/b", "/x/", "x/", "x/*", "*[!a]z", "[x", "a]b", "[]]q", "a.b+c",
        "apps/fin-*/", "docs", "/docs/**/guide.md", "", "/", "*a*b*c*", "q?", "é*", "[a-c]/x", "a^b", "[^a]b", "[a&&b]x"]
ODD = ["a", "b", "x.py", "x/y.py", "a/tests/b", "a/q/b", "x", "x/y", "bz", "az", "[x", "a]b", "]q", "a.b+c", "apps/fin-1",
       "apps/fin-1/src/m.py", "docs", "docs/a/guide.md", "docs/x", "aabbcc", "qz", "été", "b/x", "d/x", "a^b", "^b", "&x",
       "x.p", "*.py/z", "apps", "*", ""]


def test_ways_of_a_pattern_are_its_regex(spark):
    """Built natively for rule tables, by Python for inlined rules; and factors are necessary."""
    table = spark.createDataFrame([(p,) for p in MANY], "pattern string")
    for ways, regex, subject in (
        (rule_ways, rule_regex, lambda p: p), (coverage_ways, coverage_regex, lambda p: f"/{p.strip('/')}/")):
        for row in table.select("pattern", ways(F.col("pattern")).alias("ways")).collect():
            for path in map(subject, ODD):
                hits = [w for w in row.ways if re.search(w.regex, path)]
                assert bool(hits) == bool(re.search(regex(row.pattern), path)), (row.pattern, path)
                for w in hits:
                    assert path.startswith(w.head) and path.endswith(w.tail) and w.middle in path


@pytest.mark.parametrize("matcher", [rules.LENIENT, rules.STRICT])
def test_rule_table_equals_every_pair(spark, rows, matcher):
    listed = spark.createDataFrame([(i // 2, p, [f"@{i}"]) for i, p in enumerate(MANY)],
                                   "ord int, pattern string, owners array<string>")
    found = rows(rules.covering_rule(paths(spark, ODD), "path", listed, matcher))
    want = []
    for path in ODD:
        subject = path if matcher is rules.LENIENT else f"/{path.strip('/')}/"
        hits = [(i // 2, p, [f"@{i}"]) for i, p in enumerate(MANY) if re.search(matcher.regex(p), subject)]
        want += [(path, *max(hits))] if hits else []
    assert found == sorted(want, key=repr)


def test_rules_that_share_a_place_give_one_row(spark, rows):
    """Two files merged: their lines have the same numbers."""
    listed = spark.createDataFrame(
        [(1, "a/", ["@one"]), (1, "a/b/", ["@two"]), (2, "*.py", ["@py"]), (2, "a/b/", ["@three"]), (2, "a/b/", ["@zed"])],
        "ord int, pattern string, owners array<string>")
    for limit in (1, 200):
        found = rules.last_match(paths(spark, ["a/x", "a/b/c", "m.py", "q"]), "path", listed, "@d", limit)
        assert rows(found.select("path", "pattern", "owners")) == sorted([
            ("a/x", "a/", ["@one"]), ("a/b/c", "a/b/", ["@zed"]), ("m.py", "*.py", ["@py"]), ("q", "*", ["@d"])], key=repr)


def test_rule_tables_need_no_python(spark):
    found = rules.last_match(paths(spark), "path", as_table(spark, RULES), max_inline=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def lines(spark, text):
    return spark.createDataFrame(list(enumerate(text.split("\n"))), "ord bigint, line string")


def test_parse_rules(spark, rows):
    text = "# head\n\n*   @a\n /x/  @b  @c # why\n/only/\n/y @d words"
    plain = [(2, "*", ["@a"]), (3, "x/", ["@b", "@c", "#", "why"]), (5, "y", ["@d", "words"])]
    assert rows(rules.parse_rules(lines(spark, text))) == plain
    strict = [(2, "*", ["@a"]), (3, "/x/", ["@b", "@c"]), (5, "/y", ["@d"])]
    parsed = rules.parse_rules(lines(spark, text), inline_comments=True)
    assert rows(parsed) == strict
    assert rows(rules.flatten_distinct(parsed)) == [("@a",), ("@b",), ("@c",), ("@d",)]


def test_reference_check(spark, rows):
    refs = spark.createDataFrame(
        [("@x", f"f{i}") for i in range(5)] + [("@x", "f1"), ("@ok", "f1")], "name string, path string")
    declared = spark.createDataFrame([("@ok",), ("@unused",), ("@allowed",), ("@unused",)], "name string")
    assert rows(rules.reference_check(refs, declared, ["@allowed"])) == [
        ("@unused", 0, "warning", ""), ("@x", 5, "error", "f0, f1, f2")]


def test_mentions(spark, rows):
    corpus = spark.createDataFrame([("p", "@t/a_b @t/a_b x@t/c-1!"), ("q", "none")], "path string, text string")
    assert rows(rules.mentions(corpus, "@t/[a-zA-Z0-9_-]+")) == [("@t/a_b", "p"), ("@t/c-1", "p")]


def status(spark):
    def one(*names):
        return spark.createDataFrame([(n,) for n in names], "path string")

    listed = [Rule("*", ("@p",)), Rule("apps/gone/", ("@g",)), Rule("apps/a/", ("@a",)), Rule("libs/", ("@l",))]
    return rules.folder_status(
        one("apps/a", "libs/b", "dbt/c"), one("apps/a", "apps/lost"), one("apps/a", "apps/gone"), listed, "@p")


def test_folder_status(spark):
    got = {r.path: r for r in status(spark).collect()}
    assert set(got) == {"apps/a", "libs/b", "dbt/c", "apps/gone", "apps/lost"}
    assert got["apps/a"].actions == []
    assert got["libs/b"].actions == [rules.ADD_GUIDE]
    assert got["dbt/c"].actions == [rules.ASSIGN_OWNER, rules.ADD_GUIDE]
    assert got["apps/gone"].actions == [rules.CREATE_FOLDER, rules.ADD_TO_CATALOGUE]
    assert not got["apps/gone"].has_guide
    assert got["apps/lost"].actions == [rules.CREATE_FOLDER, rules.ASSIGN_OWNER]


def test_summaries(spark, rows):
    found = status(spark)
    assert rows(rules.section_summary(found, ("apps", "libs", "dbt", "docs"))) == [
        ("TOTAL", 5, 1, 4), ("apps", 3, 1, 2), ("dbt", 1, 0, 1), ("docs", 0, 0, 0), ("libs", 1, 0, 1)]
    assert ("@p", 2, 0, 2) in rows(rules.owner_summary(found))
    assert ("@l", "libs/b") in rows(rules.owner_members(found))
    none = found.select("path").filter("false")
    stale = rules.stale(none, none, "path", "s", "r")
    assert rules.overall_status(found, stale).first() == (5, 4, 0, "NEEDS ATTENTION")
    assert rules.overall_status(found.filter("path = 'apps/a'"), stale).first() == (1, 0, 0, "PASS")
    one = rules.stale(found.select("path").limit(1), none, "path", "s", "r")
    assert rules.overall_status(found.filter("path = 'apps/a'"), one).first()[3] == "NEEDS ATTENTION"
    assert rules.overall_status(found.filter("false"), stale).first() == (0, 0, 0, "PASS")


def test_inventory_and_examples(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(rules.inventory({"a": a, "b": b}, "k")) == [(1, True, False), (2, True, True), (3, False, True)]
    items = spark.createDataFrame([("x", i % 7) for i in range(50)] + [("y", 1)], "key string, item int")
    found = rules.examples(items, "key", "item", 2).select("key", "item", "position", "n_items")
    assert rows(found) == [("x", 0, 1, 7), ("x", 1, 2, 7), ("y", 1, 1, 1)]
