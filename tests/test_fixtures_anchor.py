"""Anchor counts of the derived loan tables and the report at sf0.001."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrearly.operators import calls as CL
from arrearly.operators import loans as LN
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.plans import fused, report
from arrearly.sources.tables import LoanTables


def test_table_sizes(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    assert t.loan_master.count() == 1500
    assert LN.loans_base(t.loan_master).count() == 1352
    assert t.installments.count() == 6000
    assert t.calls.count() == 3023
    assert CL.queue_calls(t.calls, Params.of(FIXTURE_AS_OF)).count() == 1991
    assert t.bucket_flow.count() == 33358
    assert t.contacts.count() == 273
    assert t.contacts.where("ACTIVE = 'Y'").count() == 232


def test_report_counts(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    p = Params.of(FIXTURE_AS_OF)
    for build in (report.delinquency_report, fused.delinquency_report_fused):
        df = build(t, p)
        counts = {r["Segment"]: r["n"] for r in df.groupBy("Segment").agg(F.count("*").alias("n")).collect()}
        assert counts == {"NA": 2025, "Segment A": 8, "Segment B": 4, "Segment C": 374}
        assert len(df.columns) == 20


def test_fused_equals_stepwise(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    p = Params.of(FIXTURE_AS_OF)
    a = report.delinquency_report(t, p)
    b = fused.delinquency_report_fused(t, p)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
