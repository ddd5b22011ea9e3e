"""The physical plans a large input gets (broadcast joins disabled): scan and
exchange counts, pushdown, no pair-producing joins, hash aggregation only."""

from __future__ import annotations

import re

import pytest

from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators import segments as SG
from arrearly.operators.nullsafe import not_in
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.plans import fused
from arrearly.session import scratch_path
from arrearly.sources.tables import LoanTables

P = Params.of(FIXTURE_AS_OF)
SCALE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def tables(spark, sf0001):
    root = scratch_path(spark, "t-plan-tables")
    LoanTables.from_fixtures(spark, sf0001).write_parquet(root)
    return LoanTables.from_parquet(spark, root)


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k, None) for k in SCALE}
    for k, v in SCALE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(df) -> list[str]:
    """The plan's operators, each once, however often the tree shows it."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"^\(\d+\) (.*)$", text, re.M)


def _count(df, name) -> int:
    return sum(x.startswith(name) for x in _nodes(df))


def test_fused_report_plan_shape(tables, at_scale):
    df = fused.delinquency_report_fused(tables, P)
    # master x3 (flags, report rows, report rows without account), calls, bucket flow, installments, contacts, NULL-paid test
    assert _count(df, "Scan parquet") == 8, _plan(df)
    assert _count(df, "Exchange") == 8, _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "ObjectHashAggregate",
                "BatchEvalPython", "ArrowEvalPython", "Window"):
        assert bad not in _plan(df), bad


def test_master_scans_are_pruned_by_dpd(tables, at_scale, spark):
    for df in (fused.delinquency_report_fused(tables, P), SG.segment_a(tables, P), SG.segment_b(tables, P), SG.segment_c(tables, P),
               LN.loans_base(tables.loan_master)):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        scans = [x for x in text.split("\n\n") if "Scan parquet" in x and "loan_master" in x]
        rules = [x for x in scans if "obsFPD00" not in x or "currentDelinquency" in x]  # the early-default set has no DPD rule
        assert rules and all("GreaterThan(currentDelinquency," in x for x in rules), text


def test_call_and_installment_rows_no_rule_reads_are_not_scanned(tables, at_scale, spark):
    text = spark._jvm.PythonSQLUtils.explainString(fused.delinquency_report_fused(tables, P)._jdf.queryExecution(), "formatted")
    pushed = [x for x in text.splitlines() if x.startswith("PushedFilters")]
    assert any("In(campaignName" in x and "EqualTo(connected,0)" in x for x in pushed)
    assert any("LessThanOrEqual(installmentDueDate" in x and "EqualTo(isCurrentDelinquent,1)" in x for x in pushed)


def test_segments_compute_each_key_set_once(tables, at_scale):
    for build, scans in ((SG.segment_a, 6), (SG.segment_b, 5), (SG.segment_c, 6)):
        df = build(tables, P)
        assert _count(df, "Scan parquet") <= scans, (build.__name__, _plan(df))


def test_filters_reach_the_scans(tables, at_scale, spark):
    df = fused.delinquency_report_fused(tables, P)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [x for x in text.splitlines() if x.startswith("PushedFilters")]
    assert any("IsNotNull(loanAccountNumber)" in x for x in pushed)
    # both DPD ranges of the bucket flow in one pushed filter
    assert any("GreaterThanOrEqual(Max_current_DPD,1)" in x and "GreaterThanOrEqual(Max_current_DPD,61)" in x
               for x in pushed)
    # the NULL-account payment test reads only NULL accounts
    assert "IsNull(loanAccountNumber)" in text
    # the report population filter and the active-contact filter
    assert any("EqualTo(flagDisbursement,1)" in x for x in pushed)
    assert any("EqualTo(ACTIVE,Y)" in x for x in pushed)


def test_not_in_is_not_the_broadcast_only_null_aware_join(tables, at_scale):
    df = not_in(LN.in_dpd_band(tables.loan_master, P.band_c), IN.paid_recently(tables.installments, P))
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "LeftAnti, BuildRight, true" not in plan  # Spark's null-aware anti join (always broadcast)


def test_latest_row_state_is_one_hash_aggregate(tables, at_scale):
    plan = _plan(IN.latest_state(tables.installments, P))
    assert "SortAggregate" not in plan and "Join" not in plan
    assert plan.count("Exchange") == 1
