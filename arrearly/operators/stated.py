"""The segment rules as the requirement states them, beside the implemented ones.

Differences to the implemented rules (see the README): attempts are distinct days in the
early part of the current cycle; "no contact" is the absence of a connected call;
a partial payment of the latest due installment excludes a loan; promises
count from the start of the current cycle; Segment A is for SIL and QL BO
products; one contact number per customer. The DPD bands are those of ``Params``.

A contact is a call that connected (connected = 1; missing is not connected) on or
before the run date, of any campaign, with a known account.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearly import params as P
from arrearly.functions import columns as C
from arrearly.operators import calls as CL
from arrearly.operators import contacts as CT
from arrearly.operators import cycles as CY
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators.keyfilter import BITS, may_hold
from arrearly.operators.nullsafe import KEY, left_join_spread, mark, not_in, semi
from arrearly.params import Params
from arrearly.sources.tables import LoanTables

PRODUCTS = (P.PRODUCT_SIL, P.PRODUCT_SIL_ONLINE, P.PRODUCT_QL_BO)


def _connected_upto(p: Params) -> Column:
    return (F.col("connected") == 1) & (F.col("callDatetime") < F.lit(p.as_of + dt.timedelta(days=1)))


def contact_state(calls: DataFrame, p: Params) -> DataFrame:
    """Per account with a call in the trailing window: (calls, contacts,
    only_refusals). only_refusals: every contact of the window is a refusal; true of an
    account without contacts (the empty set satisfies "all"). One aggregate: "all contacts
    are refusals" is "no contact is anything else"."""
    window = C.trailing_window("callDatetime", p.as_of, p.unconnected_days)
    contact = F.coalesce(F.col("connected") == 1, F.lit(False))
    return (
        calls.where(F.col(KEY).isNotNull() & window)
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if(contact).alias("contacts"),
             F.every(~contact | C.is_refusal()).alias("only_refusals"))
    )


def segment_b_contact(loan_master: DataFrame, calls: DataFrame, p: Params, bits: int = BITS) -> DataFrame:
    """(account, calls, contacts, no_contact, only_refusals, qualifies) of each
    account with a loan in band B: no contact in the trailing window, or only
    refusals. An account without calls qualifies: it has no contact."""
    band = LN.in_dpd_band(loan_master, p.band_b).where(F.col(KEY).isNotNull()).select(KEY).distinct()
    zero = F.lit(0).cast("bigint")
    state = contact_state(calls.where(may_hold(band, KEY, bits)), p)
    no_contact = F.coalesce("contacts", zero) == 0
    refused = F.coalesce("only_refusals", F.lit(True)) & ~no_contact
    return band.join(state, KEY, "left").select(
        KEY, F.coalesce("calls", zero).alias("calls"), F.coalesce("contacts", zero).alias("contacts"),
        no_contact.alias("no_contact"), refused.alias("only_refusals"), (no_contact | refused).alias("qualifies"))


def no_contact_since_disbursement(loan_master: DataFrame, calls: DataFrame, p: Params, bits: int = BITS) -> DataFrame:
    """(account, disbursementDateTime, last_contact) of band A loans without a
    contact since their disbursement (a contact in the same moment is one). A loan without a
    disbursement time qualifies only if it never had a contact.

    The lower bound differs per loan, but "no contact at or after it" needs only
    the latest contact of the account, so the anti join is one-to-one. Calls
    of accounts outside the band are dropped by a bit filter in the scan's
    stage, before the shuffle; the join behind it is exact."""
    loans = LN.in_dpd_band(loan_master, p.band_a).where(F.col(KEY).isNotNull()).select(KEY, "disbursementDateTime")
    last = (
        calls.where(_connected_upto(p) & F.col(KEY).isNotNull() & may_hold(loans, KEY, bits))
        .groupBy(KEY).agg(F.max("callDatetime").alias("last_contact"))
    )
    silent = F.col("last_contact").isNull() | F.coalesce(F.col("last_contact") < F.col("disbursementDateTime"), F.lit(False))
    return loans.join(last, KEY, "left").where(silent)


def first_contacts(contacts: DataFrame) -> DataFrame:
    """(customer_id, new_mobile_number, change_date): each customer's oldest active
    contact, ties by the smaller number, missing dates and numbers first, as the ranking has
    it. A minimum, so a hot customer collapses to one row per map task."""
    first = F.min(F.struct("change_date", "new_mobile_number")).alias("c")
    return CT.active_contacts(contacts).groupBy("customer_id").agg(first).select("customer_id", "c.new_mobile_number", "c.change_date")


def with_one_contact(loans: DataFrame, contacts: DataFrame) -> DataFrame:
    """``loans`` (one row each) with the number of one contact per customer and the primary number."""
    found = first_contacts(contacts).select(F.col("customer_id").alias("customerId"), F.col("new_mobile_number").alias("contact_number"))
    joined = left_join_spread(loans, found.where(F.col("customerId").isNotNull()), "customerId", KEY)
    return joined.withColumn("primary_number", C.key_text(F.coalesce("mobileNo", "contact_number")))


def partial_payers(inst: DataFrame, p: Params) -> DataFrame:
    """Accounts whose latest due installment is a partial payment."""
    partial = F.col("directDebitStatus") == F.lit(P.PARTIAL_PAYMENT_STATUS)
    return IN.latest_installment(inst, p).where(partial).select(KEY).distinct()


def segment_a(t: LoanTables, p: Params) -> DataFrame:
    lm = LN.in_dpd_band(t.loan_master, p.band_a).where(F.col(KEY).isNotNull() & C.early_default() & C.product_class().isin(list(PRODUCTS)))
    lm = semi(lm.select(KEY), no_contact_since_disbursement(t.loan_master, t.calls, p))
    lm = semi(lm, CY.attempts_over(t.calls, t.bucket_flow, p))
    return not_in(lm, partial_payers(t.installments, p), keys_not_null=True, left_not_null=True)


def segment_b(t: LoanTables, p: Params) -> DataFrame:
    lm = segment_b_contact(t.loan_master, t.calls, p).where(F.col("qualifies")).select(KEY)
    lm = not_in(lm, CY.promised_in_current(t.calls, t.bucket_flow, p), keys_not_null=True, left_not_null=True)
    return not_in(lm, partial_payers(t.installments, p), keys_not_null=True, left_not_null=True)


def segment_c(t: LoanTables, p: Params) -> DataFrame:
    """As implemented, but a payment of an unknown account says nothing about the others."""
    lm = LN.in_dpd_band(t.loan_master, p.band_c).where(F.col(KEY).isNotNull()).select(KEY)
    lm = not_in(lm, CL.kept_ptp(t.calls, p), keys_not_null=True, left_not_null=True)
    paid = IN.paid_recently(t.installments, p).where(F.col(KEY).isNotNull())
    return not_in(lm, paid, keys_not_null=True, left_not_null=True)


def label_segment(base: DataFrame, t: LoanTables, p: Params) -> DataFrame:
    """``base`` (rows kept) with the stated rules' ``Segment``; a loan without an account is in none."""
    la, lb, lc = P.SEGMENT_LABELS
    known = mark(base.where(F.col(KEY).isNotNull()), [(segment_a(t, p), la), (segment_b(t, p), lb), (segment_c(t, p), lc)],
                 "Segment", P.NO_SEGMENT_LABEL)
    return known.unionByName(base.where(F.col(KEY).isNull()).withColumn("Segment", F.lit(P.NO_SEGMENT_LABEL)))


def segment_labels(t: LoanTables, p: Params) -> DataFrame:
    """(account, Segment) of the report population by the stated rules."""
    return label_segment(LN.loans_base(t.loan_master).select(KEY), t, p)
