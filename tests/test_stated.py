"""The rules as the requirement states them."""

from __future__ import annotations

import random

import pytest
from conftest import call, d, frame, loan, tables, ts
from test_plans import SCALE, _count, _nodes, _plan

from arrearly.operators import keyfilter as KF
from arrearly.operators import stated as ST
from arrearly.params import Params
from arrearly.session import scratch_path
from arrearly.sources.tables import LoanTables

P = Params.of("2024-02-10")


def test_only_refusals_or_no_contact(spark):
    lm = frame(spark, "loan_master", [loan(a, 75) for a in range(1, 9)] + [loan(9, 95), loan(10, 60), loan(None, 75), loan(1, 80)])
    recent, old = "2024-02-01 10:00:00", "2023-12-01 10:00:00"
    refuse = dict(genesysWrapupDisposition="REFUSE to pay")
    calls = frame(spark, "calls", [
        call(2, recent, connected=0), call(2, recent, connected=None),  # tried, never reached
        call(3, recent, **refuse), call(3, recent, connected=0),  # only refusals
        call(4, recent, **refuse), call(4, recent),  # a refusal and another contact
        call(5, recent),  # a contact
        call(6, old),  # a contact before the window
        call(7, recent, connected=1, subdisposition="client refused", mobileNumber=None), call(7, "2024-02-11 00:00:00"),  # later calls do not count
        call(8, recent, connected=None, genesysWrapupDisposition=None, subdisposition=None),
        call(9, recent), call(None, recent)])
    got = {r.loanAccountNumber: (r.calls, r.contacts, r.no_contact, r.only_refusals, r.qualifies) for r in ST.segment_b_contact(lm, calls, P).collect()}
    assert got == {
        1: (0, 0, True, False, True), 2: (2, 0, True, False, True), 3: (2, 1, False, True, True), 4: (2, 2, False, False, False),
        5: (1, 1, False, False, False), 6: (0, 0, True, False, True), 7: (1, 1, False, True, True), 8: (1, 0, True, False, True)}
    assert ST.segment_b_contact(lm.limit(0), calls, P).count() == 0
    assert ST.segment_b_contact(lm, calls.limit(0), P).where("qualifies").count() == 8


def test_no_contact_since_disbursement(spark):
    day = ts("2023-06-01 12:00:00")
    lm = [loan(a, 30, disbursementDateTime=day) for a in range(1, 7)]
    lm += [loan(7, 30, disbursementDateTime=None), loan(8, 30, disbursementDateTime=None), loan(9, 20), loan(10, 61), loan(None, 30),
           loan(2, 40, disbursementDateTime=ts("2024-01-05 00:00:00"))]  # two loans of one account
    calls = [call(2, "2024-01-01 10:00:00"), call(3, "2023-05-31 10:00:00"), call(4, "2023-06-01 12:00:00"), call(5, "2024-01-01 10:00:00", connected=0),
             call(5, "2024-01-01 10:00:00", connected=None), call(6, "2024-02-11 00:00:00"), call(8, "2020-01-01 10:00:00", mobileNumber=None, campaignName=None),
             call(None, "2024-01-01 10:00:00")]
    for bits in (64, KF.BITS):  # a filter that lets all pass changes nothing
        got = ST.no_contact_since_disbursement(frame(spark, "loan_master", lm), frame(spark, "calls", calls), P, bits=bits).collect()
        assert sorted((r.loanAccountNumber, r.disbursementDateTime, r.last_contact) for r in got if r.disbursementDateTime) == [
            (1, day, None), (2, ts("2024-01-05 00:00:00"), ts("2024-01-01 10:00:00")), (3, day, ts("2023-05-31 10:00:00")), (5, day, None), (6, day, None)]
        assert [r.loanAccountNumber for r in got if not r.disbursementDateTime] == [7]


def test_bit_filter(spark):
    keys = spark.createDataFrame([(i * 7,) for i in range(500)] + [(None,), (0,)], "k long")
    rows = spark.range(-2000, 8000).selectExpr("id AS k").unionByName(spark.createDataFrame([(None,)], "k long"))
    for bits in (64, 1 << 12, 1 << 18):
        kept = {r.k for r in rows.where(KF.may_hold(keys, "k", bits)).collect()}
        assert {i * 7 for i in range(500)} <= kept and None not in kept
        assert len(kept) <= 500 + 10_000 * min(1, 500 / bits) * 1.3
    assert rows.where(KF.may_hold(keys.limit(0), "k", 1 << 12)).count() == 0
    with pytest.raises(AssertionError):
        KF.may_hold(keys, "k", 100)


def test_filter_lies_under_the_exchange(spark, sf0001):
    root = scratch_path(spark, "t-stated-tables")
    LoanTables.from_fixtures(spark, sf0001).write_parquet(root)
    t = LoanTables.from_parquet(spark, root)
    old = {k: spark.conf.get(k, None) for k in SCALE}
    for k, v in SCALE.items():
        spark.conf.set(k, v)
    try:
        df = ST.no_contact_since_disbursement(t.loan_master, t.calls, P)
        text = _plan(df)
        calls_side = text[text.index("max(callDatetime"):]
        # partial aggregate <- filter with the bit array <- scan, all before the exchange of the calls
        lines = calls_side.splitlines()
        exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(loanAccountNumber" in x)
        below = next(i for i, x in enumerate(lines) if "Filter" in x and "scalar-subquery" in x.lower() or "Filter" in x and "Subquery" in x)
        assert exchange < below < next(i for i, x in enumerate(lines) if i > below and "FileScan" in x), calls_side
        assert not any("NestedLoop" in x or "Cartesian" in x or "Python" in x for x in _nodes(df))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_contact_per_customer(spark):
    loans = [loan(1, 5, cust=1, mobileNo=None), loan(2, 5, cust=1), loan(3, 5, cust=2, mobileNo=None), loan(4, 5, cust=None, mobileNo=None), loan(5, 5, cust=3, mobileNo=None)]
    contacts = [dict(customer_id=1, new_mobile_number=n, change_date=x, ACTIVE=a) for n, x, a in [
        (50, ts("2024-01-02 00:00:00"), "Y"), (40, ts("2024-01-01 00:00:00"), "Y"), (30, ts("2024-01-01 00:00:00"), "Y"), (10, ts("2020-01-01 00:00:00"), "N")]]
    contacts += [dict(customer_id=2, new_mobile_number=70, change_date=None, ACTIVE="Y"), dict(customer_id=2, new_mobile_number=60, change_date=ts("2020-01-01 00:00:00"), ACTIVE="Y")]
    contacts += [dict(customer_id=None, new_mobile_number=99, change_date=None, ACTIVE="Y")]
    t = tables(spark, loan_master=loans, contacts=contacts)
    from arrearly.operators import loans as LN

    got = {r.loanAccountNumber: (r.contact_number, r.primary_number) for r in ST.with_one_contact(LN.loans_base(t.loan_master), t.contacts).collect()}
    assert got == {1: (30, "30"), 2: (30, "602"), 3: (70, "70"), 4: (None, None), 5: (None, None)}


def test_hot_customer_collapses_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    hot = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).cast("long").alias("customer_id"), (F.col("id") * 17 % 90_001).alias("new_mobile_number"),
                                     F.timestamp_seconds(F.col("id") % 5).cast("timestamp_ntz").alias("change_date"), F.lit("Y").alias("ACTIVE"))
    df = ST.first_contacts(hot)
    got = {r.customer_id: r.new_mobile_number for r in df.where("customer_id in (7, 9)").collect()}
    want = min(((i % 5, i * 17 % 90_001) for i in range(90_000) if i % 3))[1]
    assert got == {7: want, 9: 9 * 17}
    assert sum(x.startswith(("HashAggregate", "SortAggregate", "ObjectHashAggregate")) for x in _nodes(df)) >= 2 and _count(df, "Window") == 0


def test_stated_report_has_one_row_per_loan(spark):
    from arrearly.plans.report import delinquency_report_stated

    lm = [loan(1, 95, cust=1, mobileNo=None), loan(1, 30, cust=1), loan(2, 75, cust=2), loan(None, 95, cust=None), loan(3, 0, cust=1), loan(4, 95, cust=1, flagDisbursement=0)]
    contacts = [dict(customer_id=c, new_mobile_number=n, change_date=ts("2024-01-01 00:00:00"), ACTIVE="Y") for c in (1, 2, None) for n in (7, 8, 9)]
    t = tables(spark, loan_master=lm, contacts=contacts, installments=[dict(loanAccountNumber=None, lastPaymentDate=d("2024-02-01"))],
               calls=[call(2, "2024-02-01 10:00:00")])
    got = sorted(((r.loanAccountNumber, r.dpd, r.Segment, r.primary_number) for r in delinquency_report_stated(t, P).collect()), key=str)
    # a payment of an unknown account does not empty Segment C here
    # (a label is the account's, as in the implemented report)
    assert got == [("1", 30, "Segment C", "601"), ("1", 95, "Segment C", "7"), ("2", 75, "NA", "602"), (None, 95, "NA", "600")]


def test_stated_labels_against_loops(spark):
    """Few values, so that every rule fires; the plain form is the SQL of the registry, run here on the same rows."""
    import duckdb

    from arrearly.plans.oracle import rule_ctes, stated_ctes

    rng = random.Random(11)
    accounts = [*range(40), None]
    lm = [loan(a, rng.choice([None, 0, 15, 30, 50, 75, 85, 95]), cust=rng.randrange(9), obsFPD00=rng.choice([0, 1]), obsSPD00=1, obsTPD00=rng.choice([0, 0, 1, None]),
               loanType=rng.choice(["BNPL", "TUL", "TSBL"]), purpleKey="PK", isUserAtStore=1, disbursementDateTime=ts("2023-12-20 00:00:00")) for a in accounts]
    flow = [dict(loanAccountNumber=a, bucketDate=d(f"2024-01-{x:02d}"), Max_current_DPD=x if a % 3 else x + 40) for a in range(40) for x in range(1, 32) if a % 4 or rng.random() < 0.97]
    calls = []
    for _ in range(2500):
        a = rng.choice([x for x in accounts if x != 5])
        calls.append(call(a, f"2024-{rng.choice(['01', '01', '02'])}-{rng.randrange(1, 29):02d} 10:00:00", connected=rng.choice([0, None, 1]) if (a or 0) % 5 == 0 else 0,
                          campaignName=rng.choice(["SIP_Prod_Reminder", "WCL MARCH 3"]), PTP_Date=rng.choice([None] * 40 + [d("2024-01-05")]),
                          subdisposition=rng.choice([None, "refused", "refused"])))
    inst = [dict(loanAccountNumber=rng.choice(accounts), installmentNumber=rng.randrange(1, 4), installmentDueDate=d(f"2024-01-{rng.randrange(1, 4):02d}"),
                 directDebitStatus=rng.choice(["PARTIALPAYMENT", None, "FULLPAYMENT"]), lastPaymentDate=rng.choice([None, None, d("2024-01-15")])) for _ in range(90)]
    t = tables(spark, loan_master=lm, bucket_flow=flow, calls=calls, installments=inst)
    got = sorted((str(r.loanAccountNumber), r.Segment) for r in ST.segment_labels(t, P).collect())
    con = duckdb.connect()
    for n, df in t.as_dict().items():
        con.register(n, df.toArrow())
    rows = con.execute(f"""WITH {rule_ctes(P).lstrip()},{stated_ctes(P)} SELECT CAST(loanAccountNumber AS VARCHAR), CASE
        WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_a) THEN 'Segment A' WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_b) THEN 'Segment B'
        WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_c) THEN 'Segment C' ELSE 'NA' END FROM base""").fetchall()
    assert got == sorted((str(a), s) for a, s in rows)
    assert {s for _, s in got} == {"Segment A", "Segment B", "Segment C", "NA"}
