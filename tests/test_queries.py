"""Every registered query against its SQL counterpart, and the entry point."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as registered
from compare import connect, expected, mismatch
from tablewarden import plans
from tablewarden.context import Env, SyncSpec, shared_dir
from tablewarden.operators import marts
from tablewarden.sources.tables import read_table, shadow_write

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(plans.all_queries()))
def test_query_equals_sql(spark, con, name):
    names, rows = expected(con, registered.oracle_sql()[name])
    assert mismatch(registered.queries()[name](spark, SF), names, rows) is None


def test_every_query_has_sql():
    assert set(plans.all_queries()) == set(plans.all_sql())


def test_entry(spark):
    got = registered.entry(spark)
    assert got.count() > 0
    assert {r.email for r in got.collect()} == {"REDACTED"}
    # The masked column is not even read.
    assert "c_name" not in got._jdf.queryExecution().executedPlan().toString()


def test_environments(spark, tmp_path):
    env = Env("dev", str(tmp_path), group_prefix="acme_")
    assert (env.readers, env.region) == ("acme_pii_readers_dev", "ap-southeast-1")
    spark.range(3).write.parquet(env.path("silver.t"))
    shadow_write(spark.range(5), env, "silver.t")
    assert read_table(spark, env, "silver.t").count() == 3
    assert read_table(spark, env, "silver.t_v2").count() == 5
    with pytest.raises(ValueError):
        Env("test")
    with pytest.raises(ValueError):
        SyncSpec("a", "b", ("k",), ("ts",), "HOURLY")


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(root) and first != second


def test_budget_variance_keeps_one_sided_pairs(spark, rows):
    schema = "cost_centre string, period string, amount double"
    actual = spark.createDataFrame([("A", "p1", 1.1), ("A", "p1", 2.2), ("B", "p1", 5.0)], schema)
    budget = spark.createDataFrame([("A", "p1", 3.0), ("C", "p2", 4.0)], schema)
    got = marts.budget_variance(actual, budget)
    assert [(r[0], str(r.variance)) for r in got.orderBy("cost_centre").collect()] == [
        ("A", "0.30"), ("B", "5.00"), ("C", "-4.00")]
