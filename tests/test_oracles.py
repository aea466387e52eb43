"""Every query against its SQL twin, and a check that none joins without an equality."""

import compare
import pytest

import __spark_entry__ as entry
from agorakit.plans import catalog, oracles

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    _, problems = compare.compare(spark, duck, sf_dir, name, lambda *_: df, ORACLES[name])
    assert not problems


def test_entry_has_these_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_is_the_daily_table(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "metric_date" and len(df.columns) == 20


@pytest.mark.parametrize("name", ["d5_daily_metrics", "h1_inbox", "u12_unified_users"])
def test_generated_code_gives_the_same_rows(spark, duck, sf_dir, name):
    """The other tests run without generated code, which production uses."""
    modes = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in modes}
    try:
        for key, value in modes.items():
            spark.conf.set(key, value)
        _, problems = compare.compare(spark, duck, sf_dir, name, QUERIES[name], ORACLES[name])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert not problems
