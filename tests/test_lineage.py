from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import containment
from tablewarden.functions.text import extract_all, lines, lookup, path_segment, source_label, strip
from tablewarden.operators import lineage
from tablewarden.sources.documents import manifest_edges, parse_manifests

MANIFEST = """{"nodes": {"model.a": {"name": "a", "package_name": "core", "path": "m/a.sql",
  "config": {"materialized": "table", "contract": {"enforced": true}},
  "meta": {"classification": "Restricted", "pii": true}, "depends_on": {"nodes": ["s.x"]}},
  "model.b": {"name": "b"}}, "child_map": {"model.a": ["model.b", "exp.c"]}}"""


@pytest.mark.parametrize(
    "text",
    ["", "a", "a\n", "a\n\n", "\n", "a\r\nb", "a\rb\n", "a\x0bb\x0cc", "a b\x85c\x1cd", "x\r\n\r\n", "\r\n"],
)
def test_lines_are_those_of_splitlines(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(lines(F.col("t")).alias("l")).first().l == text.splitlines()


def test_text_helpers(spark):
    df = spark.createDataFrame([("lake.silver.t (core) (x)", "apps/a/b.py", "  a b\t\n")], "a string, p string, s string")
    got = df.select(
        source_label(F.col("a")), source_label(F.col("p")), path_segment(F.col("p"), 1),
        path_segment(F.col("p"), 9), strip(F.col("s")), extract_all(F.col("p"), "[a-z]+"),
        lookup(F.create_map(F.lit("k"), F.lit("v")), F.col("a"), F.lit("none")),
    ).first()
    assert tuple(got) == ("core", "", "a", None, "a b", ["apps", "a", "b", "py"], "none")


def test_manifests(spark, rows):
    df = spark.createDataFrame([(MANIFEST,), ("{broken",), ('{"nodes": {}}',)], "text string")
    nodes = parse_manifests(df)
    a = nodes.filter("name = 'a'").first()
    assert (a.materialized, a.contract_enforced, a.classification, a.pii) == ("table", True, "Restricted", True)
    assert (a.depends_on, a.consumed_by) == (["s.x"], ["model.b", "exp.c"])
    b = nodes.filter("name = 'b'").first()
    assert (b.materialized, b.depends_on, b.consumed_by) == (None, [], [])
    assert nodes.count() == 2
    edges = manifest_edges(nodes)
    told = {"project", "access", "materialized", "contract_enforced", "classification", "pii"}
    found = lineage.where_is(nodes, edges, "a")
    assert rows(found.filter(~F.col("relation").isin(*told))) == [
        ("model.a", "consumed_by", "exp.c"), ("model.a", "consumed_by", "model.b"),
        ("model.a", "depends_on", "s.x"), ("model.a", "located_at", "m/a.sql")]
    said = {r.relation: r.other for r in found.collect()}
    assert (said["materialized"], said["contract_enforced"], said["classification"], said["pii"]) == (
        "table", "true", "Restricted", "true")
    assert rows(lineage.where_is_in_manifests(df, "a")) == rows(found)
    plan = parse_manifests(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "variant_explode" in plan.lower() or "VariantExplode" in plan
    with pytest.raises(LookupError):
        lineage.where_is(nodes, edges, "zzz", strict=True)


def test_file_hits(spark, rows):
    paths = ["dbt/core/models/a/b.sql", "dbt/core/models/b.sql", "dbt/core/models/xb.sql", "dbt/core/b.sql",
             "apps/core/models/b.sql", "dbt/fin/models/b.sql.bak"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows(lineage.file_hits(df, "b")) == [("core", paths[0]), ("core", paths[1])]


def test_readers_of_a_node_are_those_of_its_file(spark, rows):
    def manifest(package, child):
        node = f'{{"name": "m", "package_name": "{package}", "path": "m.sql"}}'
        return f'{{"nodes": {{"model.m": {node}}}, "child_map": {{"model.m": ["{child}"]}}}}'

    files = spark.createDataFrame(
        [("one", manifest("p", "x")), ("two", manifest("q", "y")), ("three", '{"nodes": []}'), ("four", None),
         ("five", '{"child_map": {"model.m": ["z"]}}')], "path string, text string")
    nodes = parse_manifests(files, file="path").select("package_name", "consumed_by")
    assert rows(nodes) == [("p", ["x"]), ("q", ["y"])]
    found = lineage.where_is_in_manifests(files, "m", file="path")
    assert {r.other for r in found.filter("relation = 'consumed_by'").collect()} == {"x", "y"}
    with pytest.raises(LookupError):
        lineage.where_is_in_manifests(files, "none", file="path", strict=True)


def test_indented_headings_of_a_library_guide(spark):
    text = "# lib\n  What it does.\n\n  ## Owner\n   @team/a\n \n\t## Provides\n  - one\n- two\n## Consumers\n - app"
    row = lineage.library_cards(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.owner, row.provides, row.consumers) == ("@team/a", ["one", "two"], ["app"])


def test_consumers_by_text(spark, rows):
    text = "| p | `apps/one` | reads fct | `apps/two` |\n| q | `apps/three` | none |\nfct without"
    df = spark.createDataFrame([(text,)], "text string")
    assert rows(lineage.consumers_by_text(df, "fct")) == [("apps/one",), ("apps/two",)]


@pytest.mark.parametrize("limit", [500, 0])
def test_contained_words_inline_and_joined_agree(spark, rows, limit):
    texts = spark.createDataFrame(
        [("a", "needs common-spark"), ("b", "commo"), ("c", "x common y utils"), ("d", ""), ("e", None)],
        "app string, text string")
    words = spark.createDataFrame([("common",), ("common-spark",), ("utils",), ("none",), ("common",)], "lib string")
    found = containment.contained_words(texts, "text", words, "lib", max_literals=limit)
    assert rows(found) == [("a", "common"), ("a", "common-spark"), ("c", "common"), ("c", "utils")]
    assert containment.contained_words(texts, "text", words.filter("false"), "lib").count() == 0


def test_many_words_by_their_rarest_run(spark, rows, monkeypatch):
    """Short and long words, other scripts, repeated rows, texts over several blocks."""
    monkeypatch.setattr(containment, "BLOCK", 64)
    pick = random.Random(3)
    alphabet = "abcdé -ß漢"
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randrange(0, 400))) for _ in range(60)]
    words = {"".join(pick.choice(alphabet) for _ in range(pick.randrange(1, 9))) for _ in range(300)}
    words |= {t[i : i + 40] for t in texts for i in (0, 60) if t[i : i + 40]} | {"never seen here", ""}
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)] + [(99, None)], "k int, text string")
    asked = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    want = sorted(((i % 50, w) for i, t in enumerate(texts) for w in words if w and w in t), key=repr)
    assert rows(containment.contained_words(df, "text", asked, "w", max_literals=10)) == want


def test_many_words_in_long_texts_take_seconds(spark):
    texts = spark.range(20).select("id", F.expr(
        "concat_ws(' ', transform(sequence(1, 2500), i -> concat('w', hash(i, id) % 9999)))").alias("text"))
    words = spark.range(600).select(F.concat(F.lit("library-name-"), F.col("id")).alias("w")).unionByName(
        texts.limit(3).select(F.substring("text", 100, 30).alias("w")))
    begun = time.time()
    assert containment.contained_words(texts, "text", words, "w").count() == 3
    assert time.time() - begun < 30


def test_affected(spark, rows):
    def run(*values):
        changed = spark.createDataFrame([(v,) for v in values], "path string")
        declared = spark.createDataFrame([("one", "common-spark"), ("two", "other")], "app string, text string")
        return rows(lineage.affected(changed, declared))

    assert run("apps/z/src/a.py", "apps/z/b", "libs/common/x", "dbt/core/m.sql", "apps", "docs/a.md", "") == [
        ("app", "one"), ("app", "z"), ("lib", "common"), ("model_project", "core")]
    assert run("uv.lock", "tools/x.py", "infra/a/b") == [("global", "")]
    assert run("Makefile", "libs") == []


def test_boundaries(spark, rows):
    edges = spark.createDataFrame(
        [("a-b", "c_d.x"), ("a-b", "a_b.y"), ("a-b", "libs.z"), ("c-d", "a_b"), ("c-d", "a_bc")],
        "app string, module string")
    apps = spark.createDataFrame([("a-b",), ("c-d",), ("a-b",)], "name string")
    assert rows(lineage.boundary_violations(edges, apps)) == [("a-b", "c_d.x", "c-d"), ("c-d", "a_b", "a-b")]


def projects(spark, values):
    return spark.createDataFrame(
        values, "name string, folder string, owner string, inputs array<string>, outputs array<string>, schedule string")


def test_projects(spark, rows):
    df = projects(spark, [
        ("a", "apps/a", "o", ["t1 (b)", "t2 (erp)", "plain"], ["x", "y"], "daily"),
        ("b", "apps/b", "o", [], [], ""),
        ("", "apps/none", "o", [], [], ""),
    ])
    named = df.filter("name <> ''")
    assert rows(lineage.project_catalogue(df)) == [
        ("a", "apps/a", "o", "t1 (b), t2 (erp), plain", "x, y", "daily"), ("b", "apps/b", "o", "—", "—", "—")]
    assert rows(lineage.external_sources(named)) == [("erp",)]
    assert rows(lineage.read_edges(named)) == [("a", "b")]
    assert rows(lineage.read_matrix(named)) == [("a", False, True), ("b", False, False)]
    lonely = projects(spark, [("a", "f", "o", ["t (a)"], [], "")])
    assert lineage.read_matrix(lonely).count() == 0
    apart = projects(spark, [("a", "f", "o", ["t (erp)"], [], ""), ("b", "f", "o", [], [], "")])
    assert lineage.read_matrix(apart).count() == 0


def test_markdown_sections(spark):
    text = (
        "# My app\nabout\n## Inputs\n- one (a)\n  - two\n- (placeholder)\n* no\n- \n## Owner\n\n @team \n- late\n"
        "## outputs \n- out\n## Schedule\nTODO later\nhourly\n## Inputs\n- three\n### Sub\n- four\n## \n- five"
    )
    got = lineage.markdown_sections(spark.createDataFrame([(1, text), (2, "x\n## Schedule\n\ndaily")], "i int, text string"))
    first, second = got.orderBy("i").collect()
    assert (first.name, first.owner, first.schedule) == ("My app", "@team", "")
    assert (first.inputs, first.outputs) == (["one (a)", "two", "three", "four", "five"], ["out"])
    assert (second.name, second.owner, second.schedule, second.inputs) == ("", "", "daily", [])


def test_library_cards_and_search(spark, rows):
    text = "# lib\n\nReads files.\nMore.\n\nSecond.\n\n## Owner\nsomeone\n@io-team\n## Provides\n- read_CSV\n-- write\n## Consumers\n- app"
    cards = lineage.library_cards(spark.createDataFrame([("io", text), ("none", "")], "name string, text string"))
    io = cards.filter("name = 'io'").first()
    assert (io.owner, io.description) == ("@io-team", "Reads files.\nMore.")
    assert (io.provides, io.consumers) == (["read_CSV", "write"], ["app"])
    assert cards.filter("name = 'none'").first().owner == "@platform-team"
    for word, want in (("csv", ["io"]), ("FILES", ["io"]), ("NON", ["none"]), ("app", [])):
        hits = lineage.keyword_search(cards, word, ["name", "description"], ["provides"])
        assert [r.name for r in hits.collect()] == want, word
