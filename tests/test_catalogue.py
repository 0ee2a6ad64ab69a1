"""Each query against DuckDB on the smallest tables."""

import pytest

from rillstone.plans import catalogue
from tests.compare import assert_same, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert_same(catalogue.QUERIES[name](spark, sf_dir), con, catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalogue.QUERIES) <= set(e.queries())


@pytest.mark.parametrize("name", ["q01_region_rollup", "q20_snapshot_diff", "q24_power", "q28_pair_score", "q30_merge_group", "q32_field_repair_log"])
def test_plans_stay_in_the_jvm(spark, sf_dir, name):
    plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "CartesianProduct", "ArrowEval"))
