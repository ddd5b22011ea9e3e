"""Loan-master operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.operators.nullsafe import KEY
from arrearly.params import Params


def in_dpd_band(lm: DataFrame, band) -> DataFrame:
    """Loans whose DPD (missing = 0) lies in (low, high]."""
    return lm.where(C.dpd_in_band(band))


def band_label(p: Params):
    """'A' / 'B' / 'C' by DPD band, else 'none' (bands do not overlap)."""
    d = C.dpd()
    return (
        F.when(C.in_band(d, p.band_a), "A")
        .when(C.in_band(d, p.band_b), "B")
        .when(C.in_band(d, p.band_c), "C")
        .otherwise("none")
    )


def dpd_band_counts(lm: DataFrame, p: Params) -> DataFrame:
    return lm.groupBy(band_label(p).alias("band")).agg(F.count(F.lit(1)).alias("loans"))


def early_default_loans(lm: DataFrame) -> DataFrame:
    """Accounts with a first or second payment default and no third one."""
    return lm.where(C.early_default()).select(KEY)


def with_product(lm: DataFrame) -> DataFrame:
    return lm.select(KEY, "loanType", "purpleKey", "isUserAtStore", C.product_class().alias("Product"))


def base_filter():
    """Disbursed loans that are past due."""
    return (F.col("flagDisbursement") == 1) & C.dpd_in_band((0, None))


def loans_base(lm: DataFrame) -> DataFrame:
    """The report population with its per-loan columns."""
    return lm.where(base_filter()).select(
        "customerId", KEY, "disbursementDateTime", "firstName", "middleName", "lastName",
        C.client_name().alias("clientName"),
        "province",
        C.dpd().alias("dpd"),
        "Overdue_Principal", "Overdue_Interest", "Overdue_Penalty",
        C.total_overdue().alias("total_overdue_amount"),
        "outstandingBalance",
        C.total_outstanding().alias("total_outstanding_amount"),
        "mobileNo",
        C.product_class().alias("ltype"),
        "lastPaidDT", "loanPaidStatus",
    )
