"""The case report from one feature table per input (production form).

The step-by-step form scans the call log eight times and the installments six
times, one filtered key set per rule. Here every rule becomes a conditional
aggregate, so each input is aggregated to one row per account in one pass
(partial aggregation before the shuffle keeps a hot account cheap), and all
segment rules are boolean expressions over co-partitioned account tables:

* calls        -> call_spans   (per account and 16 days: every call rule, queue calls by day)
* bucket_flow  -> bucket_spans (per account and 16 days, both DPD ranges in one
                                filtered scan: early rows by day, entry date)
* call_spans FULL JOIN bucket_spans on (account, span), then per account
               -> activity_features (kept promise, unconnected, refusal, no
                  contact, last RPC day, last promise, latest promise up to
                  the run date, first 61-90 day, same-day attempts)
* installments -> installment_features (paid in window, latest-row state,
                  lowest unpaid number)
* loan_master  -> band_features (bands, early default; per account)

So each input is scanned once (the master twice: flags and report rows).

The account tables are joined once into ``account_facts`` (label + report
facts); the report joins it to the base loans and then to the contacts.

"Promise since bucket entry" (a range join) becomes ``latest promise up to
the run date >= entry day``. The only global value is the NOT IN null rule of
the payment set: "is there a NULL account paid in the window" — a scalar
subquery over a filter that Parquet answers mostly from null counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearly import params as P
from arrearly import schemas
from arrearly.functions import columns as C
from arrearly.operators import calls as CL
from arrearly.operators import daybits as DB
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators.nullsafe import KEY, left_join_known
from arrearly.params import Params
from arrearly.plans.report import attach_contacts, report_columns
from arrearly.sources.tables import LoanTables


def _acct():
    return F.col(KEY)


def _any(cond: Column) -> Column:
    """Does any row of the group satisfy cond (NULL counts as no)."""
    return F.coalesce(F.max(F.coalesce(cond, F.lit(False))), F.lit(False))


def call_spans(calls: DataFrame, p: Params) -> DataFrame:
    """Calls reduced to one row per (account, 16 call days): every call rule as an
    any()/max(), plus the number of queue calls of each day (for the same-day
    attempt count). Partial aggregation runs before the shuffle, and a hot
    account spreads over its spans. This one table feeds both the per-account
    features and the attempt join, so the call log is scanned once."""
    queue = CL.queue_filter(p)
    mobile = F.col("mobileNumber").isNotNull()
    unconnected = F.col("connected") == 0
    promise = queue & F.col("PTP_Date").isNotNull()
    upto = F.col("PTP_Date") < F.lit(p.as_of + dt.timedelta(days=1))
    campaigns = [*p.queue_campaigns, *(c for c in p.contact_campaigns if c not in p.queue_campaigns)]
    of_use = F.col("campaignName").isin(campaigns) | (unconnected & mobile)  # no rule reads other calls
    number = DB.day_number(C.day("callDatetime"))
    return (
        calls.where(_acct().isNotNull() & of_use)
        .withColumns({"span": DB.span_of(number), "_slot": F.when(queue, DB.slot_of(number))})
        .groupBy(KEY, "span")
        .agg(
            _any(queue & (F.col("PTP_Kept") == 1)
                 & C.trailing_window("Payment_Receiving_Date", p.as_of, p.kept_promise_days)).alias("kept_promise"),
            _any(unconnected & mobile
                 & C.trailing_window("callDatetime", p.as_of, p.unconnected_days)).alias("unconnected_recent"),
            _any(unconnected & mobile & C.is_refusal()).alias("refusal"),
            _any(F.col("campaignName").isin(list(p.contact_campaigns))
                 & CL.not_connected()).alias("no_contact"),
            F.max(F.when(queue & (C.rpc() == 1), C.day("callDatetime"))).alias("lastrpcdate"),
            F.max(F.when(promise, F.col("PTP_Date"))).alias("lastptpdate"),
            F.max(F.when(promise & upto, C.day("PTP_Date"))).alias("last_promise_upto"),
            *DB.slot_counts(F.col("_slot"), "queue_calls"),
        )
    )


def installment_features(inst: DataFrame, p: Params) -> DataFrame:
    due = F.col("installmentDueDate") <= F.lit(p.as_of)
    not_partial = (
        F.coalesce(F.col("directDebitStatus"), F.lit("NA")) != F.lit(P.PARTIAL_PAYMENT_STATUS)
    ).cast("int")
    paid = C.trailing_window_with_sentinel("lastPaymentDate", p.as_of, p.paid_days)
    return (
        inst.where(_acct().isNotNull() & (due | paid | (F.col("isCurrentDelinquent") == 1)))
        .groupBy(KEY)
        .agg(
            _any(paid).alias("paid_recently"),
            F.max(F.when(due, F.col("installmentNumber"))).alias("_maxnum"),
            F.max(F.when(due, IN.latest_row_rank(F.col("installmentDueDate"), F.col("installmentNumber"),
                                                 not_partial))).alias("_top"),
            F.min(F.when(F.col("isCurrentDelinquent") == 1, F.col("installmentNumber")))
            .alias("minunpaidinstallmentnumber"),
        )
        .select(
            KEY, "paid_recently", "minunpaidinstallmentnumber",
            IN.latest_row_flags(F.col("_top"), F.col("_maxnum"))[1].alias("latest_not_partial"),
        )
    )


def paid_null_account(inst: DataFrame, p: Params) -> Column:
    """Scalar: some installment with a NULL account was paid in the window."""
    return inst.where(
        _acct().isNull() & C.trailing_window_with_sentinel("lastPaymentDate", p.as_of, p.paid_days)
    ).exists()


def bucket_spans(bucket: DataFrame, p: Params) -> DataFrame:
    """Bucket rows of both DPD ranges reduced to one row per (account, 16 days):
    the number of early-DPD rows of each day and the earliest bucket date in the entry
    range. Feeds both the entry day and the attempt join (one scan). The bucket flow has
    a row per account and day, so per day nothing would be reduced before the shuffle."""
    dpd = F.col("Max_current_DPD")
    early = dpd.between(*p.early_dpd)
    entry = dpd.between(*p.bucket_entry_dpd)
    number = DB.day_number(C.day("bucketDate"))
    return (
        bucket.where(_acct().isNotNull() & (early | entry))
        .withColumns({"span": DB.span_of(number), "_slot": F.when(early, DB.slot_of(number))})
        .groupBy(KEY, "span")
        .agg(F.min(F.when(entry, F.col("bucketDate"))).alias("entry_date"), *DB.slot_counts(F.col("_slot"), "early_rows"))
    )


def activity_features(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Per account, from one scan of the call log and one of the bucket flow:
    the call rules, the first 61-90 DPD day and the same-day attempt count.

    The two tables are unique on (account, span) and already hash-
    partitioned on it, so their full outer join adds no exchange and is
    one-to-one; the attempt count is queue calls x early bucket rows of each
    day present on both sides (the product of the row-level join).
    """
    spans = call_spans(calls, p).join(bucket_spans(bucket, p), [KEY, "span"], "full")
    return spans.groupBy(KEY).agg(
        _any(F.col("kept_promise")).alias("kept_promise"),
        _any(F.col("unconnected_recent")).alias("unconnected_recent"),
        _any(F.col("refusal")).alias("refusal"),
        _any(F.col("no_contact")).alias("no_contact"),
        F.max("lastrpcdate").alias("lastrpcdate"),
        F.max("lastptpdate").alias("lastptpdate"),
        F.max("last_promise_upto").alias("last_promise_upto"),
        F.min("entry_date").alias("bucket_entry"),
        F.coalesce(F.sum(DB.slot_products("queue_calls", "early_rows")), F.lit(0)).alias("attempts"),
    )


def band_features(lm: DataFrame, p: Params, delinquent_only: bool = False) -> DataFrame:
    """Per master account: in which DPD bands any of its rows is, and whether
    any row is an early default (the rules test accounts, not rows).

    ``delinquent_only`` keeps the accounts with a row past due (DPD > 0), the
    only ones that can be in a segment (DPD > 20) or in the report (DPD > 0).
    Rows that are neither past due nor an early default cannot change such an
    account's flags, so they are dropped before the aggregation.
    """
    d = C.dpd()
    rows = lm.where(_acct().isNotNull())
    if delinquent_only:
        rows = rows.where(C.dpd_in_band((0, None)) | C.early_default())
    flags = rows.groupBy(KEY).agg(
        _any(C.in_band(d, p.band_a)).alias("band_a"),
        _any(C.in_band(d, p.band_b)).alias("band_b"),
        _any(C.in_band(d, p.band_c)).alias("band_c"),
        _any(C.early_default()).alias("early_default"),
        _any(d > 0).alias("delinquent"),
    )
    if delinquent_only:
        flags = flags.where(F.col("delinquent"))
    return flags.drop("delinquent")


def account_facts(t: LoanTables, p: Params, delinquent_only: bool = False) -> DataFrame:
    """One row per master account (``delinquent_only``: per account with a
    row past due): segment label and the report's call and installment facts.
    Every input is aggregated to the account once; the joins below are all on
    the account, so they are co-partitioned and add no exchange of their own."""
    f = (
        band_features(t.loan_master, p, delinquent_only)
        .join(activity_features(t.calls, t.bucket_flow, p), KEY, "left")
        .join(installment_features(t.installments, p), KEY, "left")
    )
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    promise_since_entry = F.coalesce(F.col("last_promise_upto") >= F.col("bucket_entry"), F.lit(False))
    seg_a = (yes("band_a") & yes("early_default") & no("latest_not_partial")
             & (F.coalesce(F.col("attempts"), F.lit(0)) > p.min_early_attempts) & yes("no_contact"))
    seg_b = (yes("band_b") & no("latest_not_partial") & (yes("unconnected_recent") | yes("refusal"))
             & ~promise_since_entry)
    seg_c = yes("band_c") & no("kept_promise") & no("paid_recently") & ~paid_null_account(t.installments, p)
    la, lb, lc = P.SEGMENT_LABELS
    label = F.when(seg_a, la).when(seg_b, lb).when(seg_c, lc).otherwise(P.NO_SEGMENT_LABEL)
    return f.select(KEY, label.alias("Segment"), "lastrpcdate", "lastptpdate", "minunpaidinstallmentnumber")


def segment_labels(t: LoanTables, p: Params) -> DataFrame:
    """(account, label) for accounts in some segment; A before B before C."""
    return (
        account_facts(t, p, delinquent_only=True)
        .where(F.col("Segment") != P.NO_SEGMENT_LABEL)
        .select(KEY, "Segment")
    )


def delinquency_report_fused(t: LoanTables, p: Params) -> DataFrame:
    """Report rows = base loans (one per loan) x active contacts of the
    customer; a loan without account facts (NULL account) is labelled 'NA'."""
    df = (
        left_join_known(LN.loans_base(t.loan_master), account_facts(t, p, delinquent_only=True), KEY)
        .withColumn("Segment", F.coalesce(F.col("Segment"), F.lit(P.NO_SEGMENT_LABEL)))
    )
    return report_columns(attach_contacts(df, t.contacts))


def delinquency_report_v0(t: LoanTables, p: Params) -> DataFrame:
    """The first report version: the same rows without ``loanPaidStatus``."""
    return delinquency_report_fused(t, p).select(*schemas.REPORT_V0_COLUMNS)
