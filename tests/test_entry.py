import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["item_id", "rating", "is_known", "n_neighbors"]


def _own():
    """Queries of this package alone (those of lodestar.llm have tests of their own)."""
    from lodestar.plans.catalog import all_queries

    return all_queries()


def test_every_query_has_a_twin_or_is_declared_rows_only():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(_own()) - set(sql) == {"als_fit"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")
@pytest.mark.parametrize("name", sorted(_own()))
def test_query_runs_with_stable_schema(spark, name):
    q = E.queries()[name]
    a = q(spark, SF)
    a.collect()
    assert a.schema == q(spark, SF).schema
    plan = a._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")
def test_top_k_per_item_is_limited_before_the_shuffle(spark):
    df = E.queries()["rate_all_items"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
