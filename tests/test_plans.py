"""Properties of the physical plans of all registered queries."""

import pytest

import __spark_entry__ as driver
from wattloom.plans import catalog

QUERIES = {name: driver.queries()[name] for name in catalog.load()}
# These run streams or several writes before their plan exists; tested by result only.
WRITES_FIRST = {
    "ingest_stream", "ingest_idempotent", "schema_evolution", "upsert_stream", "upsert_one_key",
    "upsert_two_keys", "upsert_idempotent", "layer_counts", "gate_layer_counts", "snapshot_read",
    "snapshot_publish", "gate_snapshot_counts",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES_FIRST])
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "MapInArrow"):
        assert operator not in text, operator


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["daily_series"](spark, sf_dir))
    assert "GreaterThanOrEqual" in text or "l_shipdate" in text
    columns = plan(QUERIES["account_metrics"](spark, sf_dir)).split("ReadSchema: ")
    assert not any("l_tax" in c or "l_discount" in c for c in columns)


def test_one_distinct_aggregate_needs_no_expand(spark, sf_dir):
    assert "Expand" not in plan(QUERIES["ingest_audit"](spark, sf_dir))


def test_comparison_uses_one_window_and_one_shuffle_per_grouping(spark, sf_dir):
    text = plan(QUERIES["investigation"](spark, sf_dir))
    assert text.count("Window [") == 1
    assert text.count("Exchange hashpartitioning") == 3  # days, months, buildings
