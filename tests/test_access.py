from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewarden.context import Caller, Env
from tablewarden.functions import masks
from tablewarden.operators import access, contract

ENV = Env("prod")
READER = Caller("gov", frozenset({"pii_readers_prod"}))
FINANCE = Caller("alice", frozenset({"finance_team_prod"}))
NO_SCOPE = Caller("zed", frozenset({"finance_team_prod"}))
OTHER = Caller("eve")
PII = {"classification": "Restricted", "mask_function": "security.mask_pii"}


@pytest.fixture
def budget(spark):
    df = spark.createDataFrame(
        [("FINANCE", 10.0, "a@x"), ("HR", 20.0, None), ("FINANCE", 30.0, "b@x")],
        "cost_centre string, budget_amount double, owner_email string",
    )
    return contract.apply_tags(df, {"owner_email": PII})


@pytest.fixture
def scope(spark):
    return spark.createDataFrame(
        [("alice", "FINANCE"), ("alice", None), ("jane", "HR")],
        "user_email string, cost_centre string",
    )


@pytest.fixture
def grants(spark):
    return spark.createDataFrame(
        [
            ("lake.gold", "finance_team_prod", ["SELECT"]),
            ("lake.gold.budget", "pii_readers_prod", ["SELECT"]),
            ("lake.gold.budget", "eve", ["MODIFY"]),
        ],
        "securable string, principal string, privileges array<string>",
    )


def read(budget, grants, scope, caller):
    return access.governed_read(
        budget, "lake.gold.budget", caller, ENV, grants, scope,
        ("security.filter_by_cost_centre", ["cost_centre"]),
    )


def test_reader_sees_everything(budget, grants, scope, rows):
    assert rows(read(budget, grants, scope, READER)) == rows(budget)


def test_team_member_sees_own_rows_masked(budget, grants, scope, rows):
    assert rows(read(budget, grants, scope, FINANCE)) == [
        ("FINANCE", 10.0, "REDACTED"),
        ("FINANCE", 30.0, "REDACTED"),
    ]


def test_member_without_scope_sees_nothing(budget, grants, scope):
    assert read(budget, grants, scope, NO_SCOPE).count() == 0


def test_no_select_is_refused(budget, grants, scope):
    with pytest.raises(PermissionError):
        read(budget, grants, scope, OTHER)


def test_unknown_caller_gets_no_rows(budget, scope):
    assert access.filter_by_scope(budget, "cost_centre", OTHER, ENV, scope).count() == 0


def test_environment_decides_the_group(budget, scope):
    assert access.filter_by_scope(budget, "cost_centre", READER, Env("dev"), scope).count() == 0


def test_long_scope_becomes_a_semi_join(spark, budget, rows, monkeypatch):
    monkeypatch.setattr(masks, "bounded_values", lambda *a, **k: None)
    scope = spark.createDataFrame([("alice", "HR")] * 3, "user_email string, cost_centre string")
    seen = access.filter_by_scope(budget, "cost_centre", FINANCE, ENV, scope)
    assert rows(seen) == [("HR", 20.0, None)]


def test_mask_hides_nulls_and_numbers(spark):
    df = spark.createDataFrame([(None, 5)], "a string, b int")
    df = contract.apply_tags(df, {"a": PII, "b": PII})
    masked = access.apply_masks(df, OTHER, ENV)
    assert masked.first() == ("REDACTED", None)
    assert masked.schema["b"].dataType == df.schema["b"].dataType
    assert masked.schema["a"].metadata["classification"] == "Restricted"


def test_predicate_on_masked_frame_sees_the_mask(spark):
    df = contract.apply_tags(spark.createDataFrame([("x",)], "a string"), {"a": PII})
    assert access.apply_masks(df, OTHER, ENV).filter("a = 'x'").count() == 0


def test_mask_folds_away(budget):
    plan = access.apply_masks(budget, OTHER, ENV)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE" not in plan and "REDACTED AS owner_email" in plan


def test_masked_view(spark, budget):
    access.masked_view(budget, ["cost_centre"], ["owner_email"], {"ops"}, OTHER, "v_masked")
    got = spark.table("v_masked")
    assert got.columns == ["cost_centre", "owner_email"]
    assert got.count() == 3 and got.filter("owner_email = 'REDACTED'").count() == 3


def test_segment_policy(spark, budget):
    def seen(caller, setting):
        return access.segment_policy(budget, caller, setting, {"gov"}, "cost_centre").count()

    assert [seen(READER, None), seen(OTHER, "HR"), seen(OTHER, None)] == [3, 1, 0]


def test_privilege_on_container_and_user(grants):
    assert access.has_privilege(grants, FINANCE, "lake.gold.any", "SELECT")
    assert not access.has_privilege(grants, FINANCE, "lake.gold.any", "MODIFY")
    assert not access.has_privilege(grants, FINANCE, "lake.golden", "SELECT")
    assert access.has_privilege(grants, OTHER, "lake.gold.budget", "MODIFY")


def test_authorise(spark, grants, rows):
    asked = spark.createDataFrame(
        [("u", "lake.gold.t", "SELECT")] * 3 + [("u", "lake.gold.t", "MODIFY"), ("eve", "lake.gold.budget", "MODIFY")],
        "user string, securable string, privilege string",
    )
    members = spark.createDataFrame(
        [("u", "finance_team_prod"), ("u", "x")], "user string, group string"
    )
    assert rows(access.authorise(asked, members, grants)) == [
        ("eve", "lake.gold.budget", "MODIFY", 1, True),
        ("u", "lake.gold.t", "MODIFY", 1, False),
        ("u", "lake.gold.t", "SELECT", 3, True),
    ]


def test_dlp_gate(budget, spark):
    assert {r.owner_email for r in access.dlp_gate(budget).collect()} == {"REDACTED"}
    with pytest.raises(access.ExportBlocked):
        access.dlp_gate(budget, "block")
    clear = spark.range(2)
    assert access.dlp_gate(clear, "block") is clear


def test_sql_function(spark):
    masks.register_masks(spark, OTHER, ENV, "m1")
    masks.register_masks(spark, READER, ENV, "m2")
    assert spark.sql("SELECT m1('x'), m2('x'), m1(NULL)").first() == ("REDACTED", "x", "REDACTED")


def test_access_review(spark, rows):
    grants = spark.createDataFrame(
        [("t1", "a", ["SELECT"]), ("t2", "a", ["SELECT"]), ("lake.audit.x", "a", ["SELECT", "MODIFY"]),
         ("t2", "gone", ["SELECT"]), ("auditor.t", "a", ["SELECT"])],
        "securable string, principal string, privileges array<string>",
    )
    pii = spark.createDataFrame([("t1", True), ("t2", False), ("t2", None)], "model string, pii boolean")
    alive = spark.createDataFrame([("a",)], "principal string")
    assert rows(access.access_review(grants, pii, alive)) == [
        ("lake.audit.x", "a", "MODIFY,SELECT", False, True, False),
        ("t1", "a", "SELECT", True, False, False),
        ("t2", "gone", "SELECT", False, False, True),
    ]
