"""Plan-regression checks: the shapes that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hublytics.plans import catalog
from hublytics.plans.explain import plan_summary
from tests.conftest import SF_CHECK

QUERIES = {n: f for n, f in entry.queries().items() if n in catalog.QUERIES}  # the library's own

# query -> max shuffles (Exchange nodes) in its physical plan
SHUFFLE_BUDGET = {
    "stg_shippingorder": 0,      # the dedup moves keys only, before
    "fct_shipping_order": 0,     # dims are broadcast
    "fct_shipment": 0, "fct_cod": 0, "fct_transportation": 0, "fct_inside_history": 0,
    "mart_daily_kpi": 1,         # one aggregate; calendar broadcast after it
    "mart_sla_breakdown": 2,     # leadtime histogram + window over the (small) histogram
    "mart_cod_reconciliation": 1,
    "mart_hub_performance": 2,   # two-level distinct aggregate
    "running_minutes": 1,        # no hot group: the plain window
    "scd2_two_runs": 2,          # one full outer join: one exchange per side
}


@pytest.mark.parametrize("name", sorted(SHUFFLE_BUDGET))
def test_shuffle_budget(spark, name):
    s = plan_summary(QUERIES[name](spark, SF_CHECK))
    assert s["shuffles"] <= SHUFFLE_BUDGET[name], s


def test_no_python_and_no_nested_loops_anywhere(spark):
    for name, fn in QUERIES.items():
        s = plan_summary(fn(spark, SF_CHECK))
        assert s["python_udfs"] == 0, name
        assert s["nested_loop_joins"] == 0, name


@pytest.mark.parametrize("name", ["stg_shippingorder", "order_dedup", "mart_daily_kpi"])
def test_dedup_moves_no_rows_and_filters_are_pushed(spark, name):
    s = plan_summary(QUERIES[name](spark, SF_CHECK))
    assert s["windows"] == 0 and s["sort_merge_joins"] == 0 and s["pushed_filter_scans"] >= 1


def test_window_dedup_limits_before_the_shuffle(spark):
    from hublytics.operators import dedup, staging
    raw = staging.keep_non_quarantine(catalog.warehouse_for(spark, SF_CHECK)[1].raw["data_shippingorder_now"])
    s = plan_summary(dedup.dedup_latest(raw, "order_code", staging.dedup_order()))
    assert s["partial_group_limits"] >= 1 and s["shuffles"] == 1 and s["pushed_filter_scans"] >= 1


def test_checks_scan_each_model_once(spark):
    s = plan_summary(QUERIES["dq_checks"](spark, SF_CHECK))
    models = {(c.layer, c.model) for c in catalog.fixture_checks()} | {(c.layer, c.to) for c in catalog.fixture_checks() if c.to}
    # staging views of five facts and dims read raw files; the two rules scan two facts, one of them twice
    assert s["scans"] <= min(40, len(models) + 3)
    assert s["shuffles"] <= 2 + 3 and s["sort_merge_joins"] == 0


def test_checks_read_written_tables(spark):
    """No check repeats the order dedup, and the profile scans a table once."""
    for name in ("dq_checks", "dq_unique", "dq_not_null", "dq_relationships", "dq_accepted", "dq_gate"):
        df = QUERIES[name](spark, SF_CHECK)
        assert "Window" not in df._jdf.queryExecution().executedPlan().toString(), name
    # eleven raw tables once each, orders and hubs once more for the orphan join
    assert plan_summary(QUERIES["dq_profile"](spark, SF_CHECK))["scans"] <= 13


def test_a_week_range_opens_its_own_folders(spark):
    df = QUERIES["export_week_range"](spark, SF_CHECK)
    assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in plan
    weeks = {r[0] for r in df.select("week_start").distinct().collect()}
    read = {f.rsplit("/", 2)[1] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert read == {f"week_start={w}" for w in weeks} and len(weeks) == 13
