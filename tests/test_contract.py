from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import contract as c
from tablewarden.sources.documents import contract_errors, contract_from_schema, contract_models, contract_table

BARE = dict(
    model="m", column="c", data_type="string", has_pii=False, pii=None, classification=None,
    has_sensitivity=False, sensitivity=None, has_retention=False, retention_days=None,
    has_mask=False, mask_function=None, no_mask_required=False,
)
FULL = {
    **BARE, "has_pii": True, "pii": True, "classification": "Restricted", "has_sensitivity": True,
    "sensitivity": "Sensitive-High", "has_retention": True, "retention_days": 2555,
    "has_mask": True, "mask_function": "security.mask_pii",
}
CASES = [
    ({}, []),
    (BARE, ["missing pii", "missing classification", "missing sensitivity", "missing retention_days"]),
    ({"classification": "Secret"}, ["invalid classification"]),
    ({"sensitivity": None}, ["invalid sensitivity"]),
    ({"retention_days": 0}, ["retention_days must be a positive integer"]),
    ({"retention_days": -1}, ["retention_days must be a positive integer"]),
    ({"retention_days": None}, ["retention_days must be a positive integer"]),
    ({"has_mask": False, "mask_function": None}, ["missing mask_function"]),
    ({"classification": "Confidential", "has_mask": False, "no_mask_required": True}, []),
    ({"has_mask": True, "mask_function": None}, []),
    ({"classification": "Official-Open", "has_mask": False}, []),
]


def frame(spark, changes):
    return spark.createDataFrame([tuple({**FULL, **x}[k] for k in FULL) for x in changes], c.COLUMNS_SCHEMA)


def test_every_rule(spark):
    for change, want in CASES:
        found = c.contract_violations(frame(spark, [change])).orderBy("position").collect()
        assert [r.violation for r in found] == want, change
        assert [r.position for r in found] == list(range(len(want)))


def test_unnamed(spark):
    found = c.contract_violations(frame(spark, [{"model": None, "column": None, "has_pii": False}]))
    assert found.first()[:2] == ("<unnamed>", "<unnamed>")


def test_warning_needs_missing_row_filter(spark, rows):
    contract = frame(spark, [{"model": "a"}, {"model": "b"}, {"model": "d", "classification": "Official-Open"},
                             {"model": "b", "classification": "Confidential"}])
    models = spark.createDataFrame([("a", True, ("f", ["x"])), ("b", True, None)], c.MODELS_SCHEMA)
    assert rows(c.contract_warnings(contract, models)) == [("b", 2)]
    assert rows(c.list_row_filters(models)) == [("a", "f", "x")]


def test_tags_round_trip(spark, tmp_path):
    df = c.apply_tags(spark.range(1).withColumn("v", F.lit("x")), {"v": {"pii": True, "retention_days": 9}})
    df.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.schema["v"].metadata == {"pii": True, "retention_days": 9}
    row = contract_from_schema(back, "t").filter("column = 'v'").first()
    assert (row.has_pii, row.pii, row.retention_days, row.has_mask) == (True, True, 9, False)
    with pytest.raises(c.ContractError):
        c.apply_tags(df, {"nope": {"pii": True}})
    with pytest.raises(c.ContractError):
        c.apply_tags(df, {"v": {"typo": 1}})


def test_derived_tags_are_the_strictest(spark):
    src = spark.createDataFrame([("a", "b")], "x string, y string")
    src = c.apply_tags(src, {
        "x": {"pii": False, "classification": "Official-Closed", "retention_days": 100, "sensitivity": "NA"},
        "y": {"pii": True, "classification": "Restricted", "retention_days": 30,
              "sensitivity": "Sensitive-High", "mask_function": "security.mask_pii"},
    })
    out = src.select(F.concat("x", "y").alias("z"))
    assert out.schema["z"].metadata == {}
    assert c.derive_tags(out, [src], {"z": ["x", "y"]}).schema["z"].metadata == {
        "pii": True, "classification": "Restricted", "sensitivity": "Sensitive-High",
        "retention_days": 30, "mask_function": "security.mask_pii",
    }


def test_enforced_contract(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    wanted = spark.createDataFrame([], "s string, n int").schema
    assert c.enforce_contract(df, wanted).first() == ("a", 1)
    with pytest.raises(c.ContractError, match="missing column n.*undeclared column k|declared"):
        c.enforce_contract(df.withColumnRenamed("n", "k"), wanted)
    with pytest.raises(c.ContractError, match="column n is bigint"):
        c.enforce_contract(df.withColumn("n", F.col("n").cast("bigint")), wanted)


def test_contract_files_tell_null_from_absent(spark, rows):
    text = """{"models": [{"name": "m", "config": {"row_filter": {"function": "f", "on_columns": ["a"]}},
      "columns": [
        {"name": "a", "meta": {"pii": true, "classification": "Restricted", "sensitivity": null,
                               "retention_days": 10, "mask_function": null}},
        {"name": "b", "meta": {"pii": true, "pii_class": "contact", "purpose": "x"}},
        {"name": "d"},
        {"name": "e", "meta": {"pii": null, "classification": "Restricted", "sensitivity": "NA",
                               "retention_days": "30", "no_mask_required": "reviewed"}},
        {"name": "f", "meta": {"pii": false, "classification": "Confidential", "sensitivity": "NA",
                               "retention_days": true, "no_mask_required": false}},
        {"name": "g", "meta": {"pii": false, "classification": 5, "sensitivity": "NA",
                               "retention_days": 30.0, "no_mask_required": 1}}]}]}"""
    files = spark.createDataFrame([(text,), ("not json",), ("[1]",)], "text string")
    found = c.contract_violations(contract_table(files)).select("column", "violation")
    assert rows(found) == [
        ("a", "invalid sensitivity"),
        ("b", "missing classification"),
        ("b", "missing retention_days"),
        ("b", "missing sensitivity"),
        ("d", "missing classification"),
        ("d", "missing pii"),
        ("d", "missing retention_days"),
        ("d", "missing sensitivity"),
        ("e", "retention_days must be a positive integer"),
        ("f", "missing mask_function"),
        ("f", "retention_days must be a positive integer"),
        ("g", "invalid classification"),
        ("g", "retention_days must be a positive integer"),
    ]
    assert rows(c.list_row_filters(contract_models(files))) == [("m", "f", "a")]


def test_broken_files_are_reported_and_files_kept_apart(spark, rows):
    good = '{"models": [{"name": "m", "config": {"row_filter": %s}, "columns": [{"name": "a", "meta": ' \
           '{"pii": true, "classification": "Restricted", "sensitivity": "NA", "retention_days": 1, "mask_function": "f"}}]}]}'
    filtered = '{"function": "f", "on_columns": ["a"]}'
    files = spark.createDataFrame(
        [("one", good % filtered), ("two", good % "{}"), ("three", good % "null"), ("half", good[:40]),
         ("blank", " \n"), ("list", "[1]"), ("unread", None)], "path string, text string")
    assert rows(contract_errors(files).select("file", "violation")) == [
        ("half", "cannot parse"), ("unread", "cannot parse")]
    found, models = contract_table(files, file="path"), contract_models(files, file="path")
    assert rows(found.select("file", "model")) == [("one", "m"), ("three", "m"), ("two", "m")]
    # A filter that is empty is none.
    assert rows(c.contract_warnings(found, models)) == [("three", "m", 1), ("two", "m", 1)]
    assert rows(c.list_row_filters(models)) == [("m", "f", "a")]
    assert c.contract_violations(found.withColumn("has_pii", F.lit(False))).columns[0] == "file"


def test_mask_coverage(spark, rows):
    contract = frame(spark, [
        {"column": "a"}, {"column": "b"}, {"column": "w", "no_mask_required": True},
        {"column": "n", "pii": False}, {"model": "other", "column": "a"},
    ])
    synced = spark.createDataFrame([("m",)], "model string")
    views = spark.createDataFrame([("m", "b")], "model string, column string")
    assert rows(c.mask_coverage(contract, synced, views)) == [("m", "a")]
