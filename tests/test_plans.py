"""Physical plan shape of the main queries."""

from starmart import fixtures
from starmart.plans import catalog as C
from starmart.sources.snapshots import load_snapshots


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _assert_clean(plan: str) -> None:
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in plan, bad


def test_headcount_plan(spark, sf):
    plan = _plan(C.fact1_headcount(spark, sf))
    _assert_clean(plan)
    assert "SinglePartition" not in plan  # no global sort / unpartitioned window on people
    assert plan.count("BroadcastHashJoin") >= 9  # nine lookups against small dimensions
    assert "partial_count" in plan  # map-side partial aggregation before the shuffle


def test_detail_plan(spark, sf):
    plan = _plan(C.employee_detail_query(spark, sf))
    _assert_clean(plan)
    assert "Window" not in plan.split("Scan")[0] or "SinglePartition" not in plan


def test_org_fact_prunes_columns(spark, sf):
    plan = _plan(C.fact2_org_count(spark, sf))
    _assert_clean(plan)
    scan = [line for line in plan.splitlines() if "FileScan" in line and "orders" in line]
    assert scan and "o_orderpriority" not in scan[0]  # grade is not needed by the org fact


def test_full_load_broadcasts_runs_and_prunes(spark, sf):
    root = fixtures.people_snapshot_tree(spark, sf)
    df = load_snapshots(spark, root, fixtures.people_runs(spark, sf))
    plan = _plan(df)
    _assert_clean(plan)
    assert "BroadcastHashJoin" in plan
    assert "dynamicpruning" in plan.lower()  # partition pruning from the chosen runs


def test_history_latest_run_has_no_window(spark, sf):
    plan = _plan(C.history_latest_run(spark, sf))
    _assert_clean(plan)
    assert "Window" not in plan
