"""Daily delinquency-bucket operators, alone and combined with calls."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.operators import calls as CL
from arrearly.operators.nullsafe import KEY
from arrearly.params import Params


def dpd_between(bucket: DataFrame, lo: int, hi: int) -> DataFrame:
    return bucket.where(F.col("Max_current_DPD").between(lo, hi))


def early_dpd_days(bucket: DataFrame, p: Params) -> DataFrame:
    """Bucket rows with DPD in the early range (inclusive)."""
    return dpd_between(bucket, *p.early_dpd)


def bucket_entry(bucket: DataFrame, p: Params) -> DataFrame:
    """First day (and lowest DPD) seen in the 61-90 range, per account."""
    return dpd_between(bucket, *p.bucket_entry_dpd).groupBy(KEY).agg(
        F.min("bucketDate").alias("bucketdate"), F.min("Max_current_DPD").alias("mindpd")
    )


def promise_upto(calls: DataFrame, p: Params) -> DataFrame:
    """Latest promise day on or before the run date, per account (queue calls,
    account and phone known)."""
    return (
        CL.queue_calls(calls, p)
        .where(F.col("PTP_Date").isNotNull() & (F.col("PTP_Date") < F.lit(p.as_of + dt.timedelta(days=1))))
        .groupBy(KEY)
        .agg(F.max(C.day("PTP_Date")).alias("last_promise_upto"))
    )


def ptp_since_bucket(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Accounts with a promise day between their bucket entry day and the run
    date. "Some promise in [entry, as_of]" is the same as "latest promise on
    or before as_of >= entry", so both sides are reduced to one row per
    account before the join: a one-to-one join, whatever the call volume."""
    e = bucket_entry(bucket, p).select(KEY, "bucketdate")
    return (
        promise_upto(calls, p)
        .join(e, KEY, "inner")
        .where(F.col("last_promise_upto") >= F.col("bucketdate"))
        .select(KEY)
    )


def bucket_rows_per_day(bucket: DataFrame, p: Params) -> DataFrame:
    """Early-DPD bucket rows counted per (account, day)."""
    return (
        early_dpd_days(bucket, p)
        .groupBy(KEY, C.day("bucketDate").alias("day"))
        .agg(F.count(F.lit(1)).alias("bucket_rows"))
    )


def call_bucket_days(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Same-day matches of queue calls and early-DPD bucket rows, per
    (account, day). The row-level join would produce calls x bucket rows for
    every (account, day); both sides are counted per (account, day) first, so
    the join is one-to-one and the match count is the product."""
    c = CL.calls_per_day(calls, p)
    b = bucket_rows_per_day(bucket, p)
    return c.join(b, [KEY, "day"], "inner").select(
        KEY, "day", "calls", "bucket_rows", (F.col("calls") * F.col("bucket_rows")).alias("matches")
    )


def early_dpd_attempts(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Per account: number of call x early-DPD bucket rows matched on the same
    day, over all history (joined rows, not distinct days)."""
    return call_bucket_days(calls, bucket, p).groupBy(KEY).agg(F.sum("matches").alias("attempts"))


def attempts_over(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Accounts with more than ``p.min_early_attempts`` matched call rows."""
    return (
        early_dpd_attempts(calls, bucket, p)
        .where(F.col("attempts") > p.min_early_attempts)
        .select(KEY)
    )

