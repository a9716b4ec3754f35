import importlib.util

import pytest
from conftest import ROOT

from checks.compare import connection, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small_tables, name):
    assert differences(spark, connection(small_tables), small_tables, name) == ""


def test_no_plan_pairs_everything(spark, small_tables):
    for name, run in QUERIES.items():
        plan = run(spark, small_tables)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry(spark, small_tables):
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() > 0
    assert set(module.oracle_sql()) <= set(module.queries())
