"""Many run dates in one job: rows of the single runs, scans of one run."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random
from collections import Counter

import pytest
from conftest import call, d, loan, tables, ts
from test_plans import SCALE, _count, _nodes

from arrearly import schemas
from arrearly.params import Params
from arrearly.plans import by_dates as BD
from arrearly.plans import fused
from arrearly.plans.registry import RUN_DATES
from arrearly.session import scratch_path
from arrearly.sources.tables import LoanTables

P = Params.of("2024-02-10")


def single_runs(t, dates):
    out = Counter()
    for x in dates:
        p = dataclasses.replace(P, as_of=x)
        out.update((*r, x) for r in map(tuple, fused.delinquency_report_fused(t, p).collect()))
    return out


def adversarial(spark, seed):
    """Small keys and dates around the borders of all windows."""
    rng = random.Random(seed)
    days = [x + dt.timedelta(days=k) for x in RUN_DATES for k in (-91, -61, -60, -31, -30, -29, -1, 0, 1)]
    accounts = [1, 2, 3, 4, 5, None]
    some = lambda *v: rng.choice([*v, None])
    return tables(
        spark,
        loan_master=[loan(rng.choice(accounts), some(0, 1, 20, 21, 60, 61, 90, 91), cust=some(1, 2), obsFPD00=some(0, 1), obsSPD00=some(1), obsTPD00=0) for _ in range(20)],
        calls=[call(rng.choice(accounts), f"{rng.choice(days)} 23:59:59", connected=some(0, 1), mobileNumber=some(5, 6), campaignName=some("PROD_Pre-Collections", "WCL MARCH 3"),
                    PTP_Kept=some(0, 1), PTP_Date=some(*days), Payment_Receiving_Date=some(*days), genesysWrapupDisposition=some("paid", "refuse")) for _ in range(150)],
        installments=[dict(loanAccountNumber=rng.choice(accounts) if rng.random() < 0.2 else rng.choice(accounts[:-1]), installmentNumber=some(1, 2, 3), installmentDueDate=some(*days),
                           directDebitStatus=some("PARTIALPAYMENT", "X"), lastPaymentDate=some(*days) if rng.random() < 0.3 else None, isCurrentDelinquent=some(0, 1)) for _ in range(60)],
        bucket_flow=[dict(loanAccountNumber=rng.choice(accounts), bucketDate=rng.choice(days), Max_current_DPD=some(0, 1, 20, 61, 90)) for _ in range(120)],
        contacts=[dict(customer_id=some(1, 2), new_mobile_number=some(7, 8), change_date=ts("2024-01-01 00:00:00"), ACTIVE=some("Y", "N")) for _ in range(6)],
    )


@pytest.mark.parametrize("seed", range(2))
def test_adversarial_tables(spark, seed):
    t = adversarial(spark, seed)
    got = Counter(map(tuple, BD.report_by_dates(t, P, RUN_DATES).collect()))
    assert got == single_runs(t, RUN_DATES)


def test_given_tables(spark, sf0001):
    root = scratch_path(spark, "t-dates")
    LoanTables.from_fixtures(spark, sf0001).write_parquet(root)
    t = LoanTables.from_parquet(spark, root)
    df = BD.report_by_dates(t, P, [x.isoformat() for x in RUN_DATES] + ["2024-02-10"])  # named twice
    assert df.columns == [*schemas.REPORT_COLUMNS, "as_of"]
    assert Counter(map(tuple, df.collect())) == single_runs(t, RUN_DATES)


def test_more_dates_than_a_pass(spark, monkeypatch):
    t = adversarial(spark, 9)
    monkeypatch.setattr(BD, "MOST", 4)
    assert Counter(map(tuple, BD.report_by_dates(t, P, RUN_DATES).collect())) == single_runs(t, RUN_DATES)
    with pytest.raises(ValueError):
        BD.report_by_dates(t, P, [])


def test_sentinel_dates(spark):
    """Around the far date that stands for a missing payment, missing payments count."""
    far = d("3000-01-01")
    t = tables(spark, loan_master=[loan(1, 95), loan(2, 95)], installments=[dict(loanAccountNumber=1, lastPaymentDate=None), dict(loanAccountNumber=2, lastPaymentDate=d("2024-01-01"))])
    unknown = tables(spark, loan_master=[loan(1, 95)], installments=[dict(loanAccountNumber=None, lastPaymentDate=None)])
    dates = [far - dt.timedelta(days=1), far + dt.timedelta(days=60), far + dt.timedelta(days=61)]
    for x in (t, unknown):
        assert Counter(map(tuple, BD.report_by_dates(x, P, dates).collect())) == single_runs(x, dates)


def test_scans_and_exchanges_of_one_run(spark, sf0001):
    root = scratch_path(spark, "t-dates-plan")
    LoanTables.from_fixtures(spark, sf0001).write_parquet(root)
    t = LoanTables.from_parquet(spark, root)
    old = {k: spark.conf.get(k, None) for k in SCALE}
    for k, v in SCALE.items():
        spark.conf.set(k, v)
    try:
        one, many = fused.delinquency_report_fused(t, P), BD.report_by_dates(t, P, RUN_DATES)
        assert _count(many, "Scan parquet") == _count(one, "Scan parquet") == 8
        assert _count(many, "Exchange hashpartitioning") <= _count(one, "Exchange hashpartitioning")
        # a single row of masks of unknown accounts is the one exchange that is another
        assert _count(many, "Exchange") <= _count(one, "Exchange") + 1
        assert not any(x.startswith(("ObjectHashAggregate", "BroadcastNestedLoop", "Cartesian", "Expand")) for x in _nodes(many))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
