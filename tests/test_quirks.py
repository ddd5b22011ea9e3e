"""Inline edge frames for the rule semantics that must be kept (Q1-Q16).

Every segment test checks the step-wise and the fused plan against the same
expected labels.
"""

from __future__ import annotations

from conftest import call, d, loan, tables, ts
from pyspark.sql import functions as F

from arrearly.operators import calls as CL
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators import segments as SG
from arrearly.operators.nullsafe import KEY
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.plans import fused, report

P = Params.of(FIXTURE_AS_OF)  # as_of 2024-02-10


def labels(t, p=P) -> dict:
    accts = t.loan_master.select(KEY).distinct()
    step = {r[KEY]: r["Segment"] for r in SG.label_segment(accts, *SG.segment_keys(t, p)).collect()}
    fus = {r[KEY]: r["Segment"] for r in fused.account_facts(t, p).select(KEY, "Segment").collect()}
    assert step == fus
    return step


def keys(df) -> set:
    return {r[0] for r in df.collect()}


def b_ready(acct):
    """A call that makes a band-B loan eligible (unconnected, recent, phone known)."""
    return call(acct, "2024-02-05 10:00:00", connected=0)


def test_q1_partial_payment_rule_is_inverted(spark):
    t = tables(
        spark,
        loan_master=[loan(i, 75) for i in (1, 2, 3, 4)],
        calls=[b_ready(i) for i in (1, 2, 3, 4)],
        installments=[
            dict(loanAccountNumber=1, installmentNumber=1, installmentDueDate=d("2024-01-05"),
                 directDebitStatus="PARTIALPAYMENT"),
            dict(loanAccountNumber=2, installmentNumber=1, installmentDueDate=d("2024-01-05"),
                 directDebitStatus="FULLPAYMENT"),
            dict(loanAccountNumber=3, installmentNumber=1, installmentDueDate=d("2024-01-05")),
            dict(loanAccountNumber=4, installmentNumber=1, installmentDueDate=d("2024-03-05"),
                 directDebitStatus="FULLPAYMENT"),
        ],
    )
    assert keys(IN.latest_not_partial(t.installments, P)) == {2, 3}
    assert labels(t) == {1: "Segment B", 2: "NA", 3: "NA", 4: "Segment B"}


def test_q2_maxima_are_independent(spark):
    inst = [
        dict(loanAccountNumber=5, installmentNumber=2, installmentDueDate=d("2024-02-01"),
             directDebitStatus="FULLPAYMENT"),
        dict(loanAccountNumber=5, installmentNumber=3, installmentDueDate=d("2024-01-01"),
             directDebitStatus="FULLPAYMENT"),
        # NULL numbers never match the maximum
        dict(loanAccountNumber=6, installmentNumber=None, installmentDueDate=d("2024-02-01")),
        dict(loanAccountNumber=6, installmentNumber=1, installmentDueDate=d("2024-01-01")),
    ]
    t = tables(spark, loan_master=[loan(5, 80), loan(6, 80)], calls=[b_ready(5), b_ready(6)], installments=inst)
    assert keys(IN.latest_installment(t.installments, P).select(KEY)) == set()
    assert keys(IN.latest_not_partial(t.installments, P)) == set()
    assert labels(t) == {5: "Segment B", 6: "Segment B"}


def test_q3_contact_fan_out(spark):
    lm = [loan(1, 10, cust=100, mobileNo=None), loan(2, 10, cust=200), loan(3, 10, cust=300)]
    contacts = [
        dict(customer_id=200, new_mobile_number=21, change_date=ts("2023-01-01 00:00:00"), ACTIVE="Y"),
        dict(customer_id=300, new_mobile_number=31, change_date=ts("2023-01-01 00:00:00"), ACTIVE="Y"),
        dict(customer_id=300, new_mobile_number=32, change_date=ts("2023-02-01 00:00:00"), ACTIVE="Y"),
        dict(customer_id=300, new_mobile_number=33, change_date=ts("2023-03-01 00:00:00"), ACTIVE="Y"),
        dict(customer_id=300, new_mobile_number=34, change_date=ts("2023-04-01 00:00:00"), ACTIVE="N"),
    ]
    t = tables(spark, loan_master=lm, contacts=contacts)
    for build in (report.delinquency_report, fused.delinquency_report_fused):
        rows = build(t, P).collect()
        per = {}
        for r in rows:
            per[r[KEY]] = per.get(r[KEY], 0) + 1
        assert per == {"1": 1, "2": 1, "3": 3}
        # the loan's own phone wins; loan 1 has none and no contact either
        assert {r["primary_number"] for r in rows if r[KEY] == "1"} == {None}
        assert {r["primary_number"] for r in rows if r[KEY] == "3"} == {"603"}


def test_q4_q5_null_propagation(spark):
    lm = [
        loan(1, 5, Total_Outstanding_Principal=10.0, Total_Outstanding_Interest=1.0, Total_Outstanding_Penalty=None,
             Overdue_Principal=None, Overdue_Interest=2.0, Overdue_Penalty=None, middleName=None),
        loan(2, 5, Total_Outstanding_Principal=None, Total_Outstanding_Interest=None, Total_Outstanding_Penalty=0.5),
    ]
    t = tables(spark, loan_master=lm)
    r = {x[KEY]: x for x in LN.loans_base(t.loan_master).collect()}
    assert r[1]["total_outstanding_amount"] is None
    assert r[1]["total_overdue_amount"] == 2.0
    assert r[1]["clientName"] is None
    assert r[2]["total_outstanding_amount"] == 0.5
    assert r[2]["clientName"] == "F M L"


def test_q6_q10_connected_semantics(spark):
    c = [
        call(1, "2024-02-01 09:00:00", connected=0, campaignName="WCL MARCH 3"),
        call(2, "2024-02-01 09:00:00", connected=1, campaignName="WCL MARCH 3"),
        call(3, "2024-02-01 09:00:00", connected=None, campaignName="WCL MARCH 3"),
        call(4, "2024-02-01 09:00:00", connected=0, campaignName="WCL MARCH 3"),
        call(4, "2024-02-02 09:00:00", connected=1, campaignName="WCL MARCH 3"),
    ]
    t = tables(spark, calls=c)
    # "no contact": an unconnected (0 or missing) call exists; a connected call does not disqualify
    assert keys(CL.no_contact(t.calls, P)) == {1, 3, 4}
    # recent unconnected: connected must be exactly 0
    assert keys(CL.unconnected_recent(t.calls, P)) == {1, 4}


def test_q7_null_account_in_payment_set(spark):
    lm = [loan(1, 95), loan(2, 95)]
    paid_inside = dict(loanAccountNumber=None, installmentNumber=1, installmentDueDate=d("2024-01-01"),
                       lastPaymentDate=d("2024-02-01"))
    paid_outside = dict(paid_inside, lastPaymentDate=d("2023-10-01"))
    t_in = tables(spark, loan_master=lm, installments=[paid_inside])
    t_out = tables(spark, loan_master=lm, installments=[paid_outside])
    assert keys(SG.segment_c(t_in, P)) == set()
    assert labels(t_in) == {1: "NA", 2: "NA"}
    assert keys(SG.segment_c(t_out, P)) == {1, 2}
    assert labels(t_out) == {1: "Segment C", 2: "Segment C"}


def _attempt_calls(acct, days_and_counts):
    out = []
    for day, n in days_and_counts:
        for i in range(n):
            out.append(call(acct, f"{day} {9 + i % 10:02d}:{i:02d}:00", connected=0))
    return out


def test_q8_attempts_count_joined_rows(spark):
    early = dict(obsFPD00=1, obsSPD00=0, obsTPD00=0)
    lm = [loan(1, 30, **early), loan(2, 30, **early), loan(3, 30, **early)]
    days10 = [(f"2024-01-{i:02d}", 1) for i in range(10, 20)]
    calls = (_attempt_calls(1, [("2024-01-15", 11)]) + _attempt_calls(2, days10)
             + _attempt_calls(3, [("2024-01-15", 6)]))
    bucket = ([dict(loanAccountNumber=1, bucketDate=d("2024-01-15"), Max_current_DPD=10)]
              + [dict(loanAccountNumber=2, bucketDate=d(day), Max_current_DPD=5) for day, _ in days10]
              + [dict(loanAccountNumber=3, bucketDate=d("2024-01-15"), Max_current_DPD=10)] * 2)
    t = tables(spark, loan_master=lm, calls=calls, bucket_flow=bucket)
    from arrearly.operators import buckets as BK
    att = {r[KEY]: r["attempts"] for r in BK.early_dpd_attempts(t.calls, t.bucket_flow, P).collect()}
    assert att == {1: 11, 2: 10, 3: 12}
    assert labels(t) == {1: "Segment A", 2: "NA", 3: "Segment A"}


def test_q9_promise_since_first_entry(spark):
    lm = [loan(i, 70) for i in (1, 2, 3, 4)]
    entry = [dict(loanAccountNumber=i, bucketDate=d("2024-01-20"), Max_current_DPD=65) for i in (1, 2, 3)]
    entry += [dict(loanAccountNumber=1, bucketDate=d("2024-01-25"), Max_current_DPD=70)]
    calls = [b_ready(i) for i in (1, 2, 3, 4)] + [
        call(1, "2024-01-02 10:00:00", PTP_Date=d("2024-01-19")),  # before entry
        call(2, "2024-01-02 10:00:00", PTP_Date=d("2024-01-20")),  # on entry
        call(3, "2024-01-02 10:00:00", PTP_Date=d("2024-02-11")),  # after run date
        call(4, "2024-01-02 10:00:00", PTP_Date=d("2024-01-25")),  # no entry at all
    ]
    t = tables(spark, loan_master=lm, calls=calls, bucket_flow=entry)
    from arrearly.operators import buckets as BK
    assert keys(BK.ptp_since_bucket(t.calls, t.bucket_flow, P)) == {2}
    assert labels(t) == {1: "Segment B", 2: "NA", 3: "Segment B", 4: "Segment B"}


def test_q11_refusal_has_no_date_limit(spark):
    c = [call(1, "2023-01-06 10:00:00", connected=0, subdisposition="Customer REFUSES")]
    t = tables(spark, loan_master=[loan(1, 70)], calls=c)
    assert keys(CL.refusals(t.calls)) == {1}
    assert labels(t) == {1: "Segment B"}


def test_q12_q13_product_not_filtered_and_segments_on_all_loans(spark):
    early = dict(obsFPD00=0, obsSPD00=1, obsTPD00=0)
    lm = [loan(1, 30, loanType="TSBL", **early), loan(2, 95, flagDisbursement=0)]
    calls = _attempt_calls(1, [("2024-01-15", 11)])
    bucket = [dict(loanAccountNumber=1, bucketDate=d("2024-01-15"), Max_current_DPD=3)]
    t = tables(spark, loan_master=lm, calls=calls, bucket_flow=bucket)
    a = SG.segment_a(t, P).collect()
    assert [(r[KEY], r["ltype"]) for r in a] == [(1, "QL FLEX")]
    assert keys(SG.segment_c(t, P)) == {2}
    rep = fused.delinquency_report_fused(t, P).collect()
    assert [(r[KEY], r["Segment"]) for r in rep] == [("1", "Segment A")]


def test_q14_band_bounds(spark):
    dpds = [None, 0, 1, 20, 21, 60, 61, 90, 91]
    lm = [loan(i, v) for i, v in enumerate(dpds)]
    t = tables(spark, loan_master=lm)
    got = {r[KEY]: r["band"] for r in t.loan_master.select(KEY, LN.band_label(P).alias("band")).collect()}
    assert [got[i] for i in range(len(dpds))] == ["none", "none", "none", "none", "A", "A", "B", "B", "C"]
    base = keys(LN.loans_base(t.loan_master).select(KEY))
    assert base == {2, 3, 4, 5, 6, 7, 8}


def test_q15_inclusive_day_windows(spark):
    c = [
        call(1, "2024-01-10 12:00:00", connected=0),  # as_of - 31
        call(2, "2024-01-11 00:00:00", connected=0),  # as_of - 30
        call(3, "2024-02-10 23:59:59", connected=0),  # as_of, last second
        call(4, "2024-02-11 00:00:00", connected=0),  # as_of + 1
        call(5, "2024-01-01 00:00:00", PTP_Kept=1, Payment_Receiving_Date=d("2023-12-11")),  # as_of - 61
        call(6, "2024-01-01 00:00:00", PTP_Kept=1, Payment_Receiving_Date=d("2023-12-12")),  # as_of - 60
        call(7, "2024-01-01 00:00:00", PTP_Kept=1, Payment_Receiving_Date=d("2024-02-10")),
        call(8, "2024-01-01 00:00:00", PTP_Kept=1, Payment_Receiving_Date=d("2024-02-11")),
    ]
    t = tables(spark, calls=c)
    assert keys(CL.unconnected_recent(t.calls, P)) == {2, 3}
    assert keys(CL.kept_ptp(t.calls, P)) == {6, 7}


def test_q16_substring_hits(spark):
    texts = ["Unpaid", "Overdue", "No payment", "payment made", None, "NA", "recall later", "Call back 3rd party"]
    c = [call(i, "2024-01-01 00:00:00", genesysWrapupDisposition=w) for i, w in enumerate(texts)]
    t = tables(spark, calls=c)
    got = {r[KEY]: (r["APC"], r["RPC"], r["TPC"]) for r in CL.disposition_tags(t.calls).collect()}
    assert [got[i] for i in range(len(texts))] == [
        (1, 1, 0), (1, 1, 0), (0, 0, 0), (1, 1, 0), (0, 0, 0), (0, 0, 0), (1, 0, 0), (1, 1, 1),
    ]


def test_product_branches(spark):
    rows = [
        loan(1, 1, loanType="BNPL", purpleKey="k", isUserAtStore=1),
        loan(2, 1, loanType="BNPL", purpleKey="k", isUserAtStore=None),
        loan(3, 1, loanType="BNPL", purpleKey="k", isUserAtStore=0),
        loan(4, 1, loanType="BNPL", purpleKey=None, isUserAtStore=1),
        loan(5, 1, loanType="TSBL"),
        loan(6, 1, loanType="TUL"),
        loan(7, 1, loanType="PL"),
        loan(8, 1, loanType="BNPL", purpleKey="k", isUserAtStore=2),
        loan(9, 1, loanType=None),
    ]
    t = tables(spark, loan_master=rows)
    got = {r[KEY]: r["Product"] for r in LN.with_product(t.loan_master).collect()}
    assert got == {1: "SIL", 2: "SIL", 3: "SIL-Online", 4: "SIL-Online", 5: "QL FLEX", 6: "QL BO",
                   7: "PL", 8: "BNPL", 9: None}


def test_label_priority_with_repeated_account(spark):
    # one account, two master rows: one in band A (qualifying), one in band C
    early = dict(obsFPD00=1, obsSPD00=0, obsTPD00=0)
    lm = [loan(1, 30, **early), loan(1, 95)]
    calls = _attempt_calls(1, [("2024-01-15", 11)])
    bucket = [dict(loanAccountNumber=1, bucketDate=d("2024-01-15"), Max_current_DPD=3)]
    t = tables(spark, loan_master=lm, calls=calls, bucket_flow=bucket)
    assert keys(SG.segment_a(t, P).select(KEY)) == {1}
    assert keys(SG.segment_c(t, P)) == {1}
    assert labels(t) == {1: "Segment A"}
    rep = fused.delinquency_report_fused(t, P)
    assert {(r[KEY], r["dpd"], r["Segment"]) for r in rep.collect()} == {("1", 30, "Segment A"),
                                                                       ("1", 95, "Segment A")}


def test_as_of_after_every_window_empties_windowed_sets(spark, sf0001):
    from arrearly.sources.tables import LoanTables

    t = LoanTables.from_fixtures(spark, sf0001)
    late = Params.of("2030-01-01")
    assert CL.kept_ptp(t.calls, late).count() == 0
    assert IN.paid_recently(t.installments, late).count() == 0
    assert CL.unconnected_recent(t.calls, late).count() == 0
    assert CL.kept_ptp(t.calls, P).count() > 0


def test_report_is_independent_of_input_partitioning(spark, sf0001):
    from arrearly.sources.tables import LoanTables

    t = LoanTables.from_fixtures(spark, sf0001)
    shuffled = LoanTables(**{n: df.repartition(7, F.rand(seed=3)) for n, df in t.as_dict().items()})
    a = fused.delinquency_report_fused(t, P)
    b = fused.delinquency_report_fused(shuffled, P)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
