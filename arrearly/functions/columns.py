"""Scalar column expressions of the collections rules.

All of these are built-in Catalyst expressions: they stay inside whole-stage
codegen and, where they compare a raw column with a literal, reach the Parquet
scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from arrearly import params as P


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- numbers -----------------------------------------------------------------

def dpd(c: str | Column = "currentDelinquency") -> Column:
    """Days past due with a missing value read as 0."""
    return F.coalesce(col(c), F.lit(0))


def in_band(value: Column, band: tuple[int, int | None]) -> Column:
    """low < value <= high (high None = unbounded). Strict on the low side."""
    lo, hi = band
    cond = value > F.lit(lo)
    if hi is not None:
        cond = cond & (value <= F.lit(hi))
    return cond


def zero_if_null_sum(*cols: str | Column) -> Column:
    """coalesce(a,0) + coalesce(b,0) + ... evaluated left to right."""
    out = None
    for c in cols:
        term = F.coalesce(col(c), F.lit(0))
        out = term if out is None else out + term
    return out


def total_outstanding(principal="Total_Outstanding_Principal",
                      interest="Total_Outstanding_Interest",
                      penalty="Total_Outstanding_Penalty") -> Column:
    """Outstanding total as the rules compute it: the penalty term is *not*
    defaulted to 0 (a one-argument coalesce), so a missing penalty makes the
    whole total missing."""
    return F.coalesce(col(principal), F.lit(0)) + F.coalesce(col(interest), F.lit(0)) + col(penalty)


def total_overdue(principal="Overdue_Principal", interest="Overdue_Interest",
                  penalty="Overdue_Penalty") -> Column:
    return zero_if_null_sum(principal, interest, penalty)


def dpd_in_band(band: tuple[int, int | None], c: str | Column = "currentDelinquency") -> Column:
    """in_band(dpd(c), band) as a row filter. For a floor of 0 or more a missing
    value fails either way, and on the raw column the test reaches the scan."""
    return in_band(col(c) if band[0] >= 0 else dpd(c), band)


# -- strings -----------------------------------------------------------------

def client_name(first="firstName", middle="middleName", last="lastName") -> Column:
    """'first middle last'; missing if any part is missing (concat semantics)."""
    return F.concat(col(first), F.lit(" "), col(middle), F.lit(" "), col(last))


def key_text(c: str | Column) -> Column:
    """Integer key as text (cast to string keeps nulls)."""
    return col(c).cast("string")


def key_text_file(c: str | Column) -> Column:
    """Key as written by the file sink: a missing key becomes the text 'None'."""
    return F.coalesce(col(c).cast("string"), F.lit("None"))


def product_class(loan_type="loanType", purple_key="purpleKey", at_store="isUserAtStore") -> Column:
    """Product name from loan type, partner key and store flag."""
    lt, pk, st = col(loan_type), col(purple_key), col(at_store)
    bnpl = lt == F.lit("BNPL")
    return (
        F.when(bnpl & pk.isNotNull() & ((st == 1) | st.isNull()), F.lit(P.PRODUCT_SIL))
        .when(bnpl & pk.isNotNull() & (st == 0), F.lit(P.PRODUCT_SIL_ONLINE))
        .when(bnpl & pk.isNull(), F.lit(P.PRODUCT_SIL_ONLINE))
        .when(lt == F.lit("TSBL"), F.lit(P.PRODUCT_QL_FLEX))
        .when(lt == F.lit("TUL"), F.lit(P.PRODUCT_QL_BO))
        .otherwise(lt)
    )


def early_default(fpd="obsFPD00", spd="obsSPD00", tpd="obsTPD00") -> Column:
    """First or second payment default, third not in default (null third fails)."""
    return ((col(fpd) == 1) | (col(spd) == 1)) & (col(tpd) == 0)


def _pattern_hit(text: Column, kind: str, needle: str) -> Column:
    if kind == "prefix":
        return text.startswith(needle)
    return text.contains(needle)


def disposition_tag(patterns, wrapup: str | Column = "genesysWrapupDisposition") -> Column:
    """1 if the upper-cased wrap-up text (missing read as 'NA') hits any pattern."""
    text = F.upper(F.coalesce(col(wrapup), F.lit("NA")))
    hit = None
    for kind, needle in patterns:
        h = _pattern_hit(text, kind, needle)
        hit = h if hit is None else (hit | h)
    return hit.cast("int")


def apc(wrapup="genesysWrapupDisposition") -> Column:
    return disposition_tag(P.APC_PATTERNS, wrapup)


def rpc(wrapup="genesysWrapupDisposition") -> Column:
    return disposition_tag(P.RPC_PATTERNS, wrapup)


def tpc(wrapup="genesysWrapupDisposition") -> Column:
    return disposition_tag(P.TPC_PATTERNS, wrapup)


def is_refusal(sub="subdisposition", wrapup="genesysWrapupDisposition") -> Column:
    """Refusal text in either disposition field (null-safe: missing = no hit)."""
    needle = P.REFUSAL_TEXT
    return F.coalesce(F.lower(col(sub)).contains(needle), F.lit(False)) | F.coalesce(
        F.lower(col(wrapup)).contains(needle), F.lit(False)
    )


# -- dates -------------------------------------------------------------------

def day(c: str | Column) -> Column:
    """Truncate a date or timestamp to its calendar day (DATE)."""
    return col(c).cast("date")


def day_between(c: str | Column, lo: dt.date, hi: dt.date) -> Column:
    """day(c) between lo and hi, written on the raw column as the half-open
    range [lo, hi + 1 day) so that it stays a pushable Parquet filter for both
    DATE and TIMESTAMP columns and never drops the last day of the window."""
    c = col(c)
    return (c >= F.lit(lo)) & (c < F.lit(hi + dt.timedelta(days=1)))


def trailing_window(c: str | Column, as_of: dt.date, days: int) -> Column:
    """day(c) in [as_of - days, as_of]: `days + 1` calendar days."""
    return day_between(c, as_of - dt.timedelta(days=days), as_of)


def trailing_window_with_sentinel(c: str | Column, as_of: dt.date, days: int,
                                  sentinel: str = P.NO_PAYMENT_SENTINEL) -> Column:
    """Window test of coalesce(c, sentinel). The sentinel branch folds to a
    constant, so the predicate stays pushable."""
    lo = as_of - dt.timedelta(days=days)
    s = dt.date.fromisoformat(sentinel)
    sentinel_inside = lo <= s <= as_of
    c = col(c)
    inside = c.isNotNull() & trailing_window(c, as_of, days)
    if sentinel_inside:
        return inside | c.isNull()
    return inside
