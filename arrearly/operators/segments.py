"""Segment rules, each written as the membership joins it is made of.

This is the readable, step-by-step form; ``arrearly.plans.fused`` computes
the same sets from one feature table per input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly import params as P
from arrearly.functions import columns as C
from arrearly.operators import buckets as BK
from arrearly.operators import calls as CL
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators.nullsafe import KEY, mark, not_in, semi
from arrearly.params import Params
from arrearly.sources.tables import LoanTables


def segment_c(t: LoanTables, p: Params) -> DataFrame:
    """DPD above band C's floor, no kept promise in the window, no payment in
    the window. The payment set is not null-guarded: one NULL account paid in
    the window leaves Segment C empty."""
    lm = LN.in_dpd_band(t.loan_master, p.band_c)
    lm = not_in(lm, CL.kept_ptp(t.calls, p), keys_not_null=True)
    lm = not_in(lm, IN.paid_recently(t.installments, p))
    return lm.select(KEY)


def _known(lm: DataFrame) -> DataFrame:
    """Rows with an account. The rule's IN tests drop the others in any case,
    so the NOT IN tests need no NULL case for them."""
    return lm.where(F.col(KEY).isNotNull())


def segment_b(t: LoanTables, p: Params) -> DataFrame:
    """Band B; latest installment not 'not partial'; an unconnected call in the
    window or a refusal; no promise since the bucket entry. All master columns."""
    lm = _known(LN.in_dpd_band(t.loan_master, p.band_b))
    lm = not_in(lm, IN.latest_not_partial(t.installments, p), keys_not_null=True, left_not_null=True)
    lm = semi(lm, CL.unconnected_or_refused(t.calls, p))
    lm = not_in(lm, BK.ptp_since_bucket(t.calls, t.bucket_flow, p), keys_not_null=True, left_not_null=True)
    return lm


def segment_a(t: LoanTables, p: Params) -> DataFrame:
    """Band A; early payment default; latest installment not 'not partial';
    more than N same-day early-DPD call attempts; an unconnected contact-
    campaign call. Returns account, DPD and product."""
    lm = _known(LN.in_dpd_band(t.loan_master, p.band_a))
    lm = semi(lm, LN.early_default_loans(t.loan_master))
    lm = not_in(lm, IN.latest_not_partial(t.installments, p), keys_not_null=True, left_not_null=True)
    lm = semi(lm, BK.attempts_over(t.calls, t.bucket_flow, p))
    lm = semi(lm, CL.no_contact(t.calls, p))
    return lm.select(KEY, "currentDelinquency", C.product_class().alias("ltype"))


def label_segment(base: DataFrame, a: DataFrame, b: DataFrame, c: DataFrame, out: str = "Segment") -> DataFrame:
    """First matching segment in A, B, C order; 'NA' otherwise (rows kept)."""
    la, lb, lc = P.SEGMENT_LABELS
    return mark(base, [(a, la), (b, lb), (c, lc)], out, P.NO_SEGMENT_LABEL)


def segment_keys(t: LoanTables, p: Params):
    return segment_a(t, p).select(KEY), segment_b(t, p).select(KEY), segment_c(t, p).select(KEY)
