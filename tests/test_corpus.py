from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import contract, corpus
from tablewarden.sources.documents import read_corpus
from tablewarden.sources.export import classification_of, export_with_header

GOOD = "# x\n## Inputs\n## Outputs\n## Rules\n"


def texts(spark, *values, path="/apps/a/guide.md"):
    return spark.createDataFrame([(f"{i}{path}", v) for i, v in enumerate(values)], "path string, text string")


def lint(spark, text, path="/apps/a/guide.md"):
    found = corpus.lint_documents(texts(spark, text, path=path))
    return sorted(r.rule for r in found.collect())


def test_lint(spark):
    assert lint(spark, GOOD) == []
    assert lint(spark, "") == ["no_heading", "no_required_phrase", "no_section:inputs", "no_section:outputs"]
    assert lint(spark, GOOD.replace("# x", "#x")) == ["no_heading"]
    assert lint(spark, GOOD + "a\n" * 196) == []
    assert lint(spark, GOOD + "a\n" * 197) == ["too_long"]
    assert lint(spark, "# x\nPublic API", path="/libs/a/guide.md") == []
    assert lint(spark, "# x\n ## Inputs\n## OUTPUTS  \nrules") == ["no_section:inputs"]


def test_forbidden_lines(spark, rows):
    text = "ok\nuv run pytest\nmake x; uv run pytest\nuv run pytest <!-- raw-ok -->\nsbt clean uv run pytest\nuv run pytest"
    found = corpus.forbidden_lines(texts(spark, text)).select("line_no", "phrase")
    assert rows(found) == [(2, "uv run pytest"), (5, "sbt clean"), (5, "uv run pytest"), (6, "uv run pytest")]


def test_hardcoded_paths(spark, rows):
    found = corpus.hardcoded_paths(texts(spark, "dbfs:/a s3://b dbfs:/c", "abfss://x /Workspace/Users/y", "none"))
    assert [r.scheme for r in found.orderBy("path", "scheme").collect()] == [
        "dbfs:/", "s3://", "/Workspace/Users/", "abfss://"]


def test_rewrite(spark):
    text = (
        "job:\n  job_id: 5\n  Catalog: LAKE_dev\n  notebook_path: /Workspace/Users/me/run\n"
        "  notebook_path: /Workspace/a/b/two.sql\n  node_type_id: i3.large\n  num_workers: 12\n"
    )
    found = corpus.rewrite_refs(
        texts(spark, text, "run_as: x\ndata: s3://b"), corpus.job_rewrites(("lake_dev", "lake_prod")),
        required={"run_as:": "no_run_as"}, collect={"notebooks": corpus.NOTEBOOK_PATH}).orderBy("path").collect()
    assert [f.notebooks for f in found] == [["/Workspace/Users/me/run", "/Workspace/a/b/two.sql"], []]
    assert found[0].rewritten == (
        "job:\n  Catalog: ${var.catalog}\n  notebook_path: ./notebooks/run.py\n"
        "  notebook_path: ./notebooks/two.sql\n  node_type_id: ${var.cluster_node_type_id}\n"
        "  num_workers: ${var.cluster_num_workers}\n")
    assert found[0].flags == ["catalog", "notebook_path", "node_type_id", "num_workers", "no_run_as"]
    assert (found[1].rewritten, found[1].flags) == ("run_as: x\ndata: s3://b", ["path:s3://"])


def test_secret_scan(spark, rows):
    head = "-----BEGIN {}PRIVATE KEY-----"
    df = texts(spark, head.format("RSA ") + "\n" + head.format(""), "BEGIN PRIVATE KEY", "x" * 50000 + head.format("EC "))
    found = corpus.secret_scan(df).select("kind", "n_matches")
    assert rows(found) == [("private_key", 1), ("private_key", 2)]


def test_read_corpus(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.md").write_text("l1\nl2\n")
    (tmp_path / "a" / "skip.md").write_text("no")
    (tmp_path / "two.txt").write_text("t")
    found = read_corpus(spark, [f"{tmp_path}/a/*.md", f"{tmp_path}/*.txt"], ["a/skip.md"])
    assert sorted(r.text for r in found.collect()) == ["l1\nl2\n", "t"]


def test_export_header_in_every_part(spark, tmp_path):
    df = spark.range(20).withColumn("name", F.lit("a,b"))
    df = contract.apply_tags(df, {"id": {"classification": "Official-Closed"}, "name": {"classification": "Confidential"}})
    assert classification_of(df) == "Confidential"
    assert classification_of(spark.range(1)) == "Official-Open"
    path = export_with_header(df.repartition(3), str(tmp_path / "csv"))
    parts = [p.read_text().splitlines() for p in (tmp_path / "csv").glob("part-*")]
    assert len(parts) == 3
    assert all(p[:2] == ["# classification: Confidential", "id,name"] for p in parts)
    assert sum(len(p) - 2 for p in parts) == 20
    assert '0,"a,b"' in {line for p in parts for line in p}
    export_with_header(df.coalesce(1), str(tmp_path / "json"), "json")
    (part,) = (tmp_path / "json").glob("part-*")
    assert part.read_text().splitlines()[:2] == ["# classification: Confidential", '{"id":0,"name":"a,b"}']
