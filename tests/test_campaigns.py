"""Campaign groups as a table against the lists in code."""

from __future__ import annotations

import pytest
from conftest import call, frame
from test_plans import _nodes

from arrearly.operators import calls as CL
from arrearly.operators import campaigns as CG
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.sources.tables import LoanTables

P = Params.of(FIXTURE_AS_OF)


@pytest.mark.parametrize("most", [CG.MOST_CAMPAIGNS, 0])
def test_groups_equal_the_lists(spark, sf0001, most):
    calls = LoanTables.from_fixtures(spark, sf0001).calls
    groups = CG.groups_of(spark, P)
    flagged = CG.with_groups(calls, groups, most)
    assert flagged.count() == calls.count()
    for name, listed in ((CG.QUEUE, P.queue_campaigns), (CG.CONTACT, P.contact_campaigns)):
        want = calls.where(calls.campaignName.isin(list(listed)))
        for got in (flagged.where(CG.in_group(name)).select(calls.columns), CG.group_calls(calls, groups, name, most)):
            assert got.columns == calls.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a rule over the table instead of the list
    rule = CG.group_calls(calls, groups, CG.CONTACT, most).where(CL.not_connected() & calls.loanAccountNumber.isNotNull()).select("loanAccountNumber").distinct()
    assert {r[0] for r in rule.collect()} == {r[0] for r in CL.no_contact(calls, P).collect()}


def test_broadcast_only_after_the_size_is_checked(spark, sf0001):
    calls, groups = LoanTables.from_fixtures(spark, sf0001).calls, CG.groups_of(spark, P)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = lambda most: [x.split(" ")[0] for x in _nodes(CG.with_groups(calls.limit(5), groups, most))]
        assert "BroadcastHashJoin" in names(100) and "BroadcastHashJoin" not in names(10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_duplicates_unknown_and_empty(spark):
    rows = [("queue", "A"), ("queue", "A"), ("contact", "A"), ("contact", "B"), ("queue", None), (None, "C"), ("other", "nowhere")]
    groups = spark.createDataFrame(rows, "`group` string, campaign string")
    calls = frame(spark, "calls", [call(1, "2024-01-01 00:00:00", campaignName=c, connected=x) for c, x in [("A", 0), ("A", 1), ("B", None), ("C", 0), ("unlisted", 0), (None, 0)]]
                  + [call(None, "2024-01-01 00:00:00", campaignName="B", connected=0), call(2, "2024-01-01 00:00:00", campaignName="C")])
    got = {(r.campaignName, r.connected): sorted(r.groups) for r in CG.with_groups(calls, groups).where("loanAccountNumber = 1").collect()}
    assert got == {("A", 0): ["contact", "queue"], ("A", 1): ["contact", "queue"], ("B", None): ["contact"], ("C", 0): [], ("unlisted", 0): [], (None, 0): []}
    counts = {r.loanAccountNumber: (r.queue_calls, r.contact_calls, r.unconnected_contact_calls) for r in CG.campaign_group_calls(calls, groups).collect()}
    assert counts == {1: (2, 3, 2), None: (0, 1, 1)}
    assert CG.group_calls(calls, groups, "missing").count() == 0 and CG.group_calls(calls, groups, "queue").count() == 2
    none = groups.limit(0)
    assert CG.campaign_group_calls(calls, none).count() == 0 and CG.with_groups(calls, none).count() == 8
    clash = calls.withColumnRenamed("customerId", "campaign_").selectExpr("*", "1 AS `group`")
    assert CG.with_groups(clash, groups).count() == 8
