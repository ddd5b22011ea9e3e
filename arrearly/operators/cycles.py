"""Delinquency cycles, and calls and promises inside them.

A day is delinquent if the highest DPD of its bucket rows is above 0 (a NULL
DPD counts as 0). A day without bucket rows is not delinquent. A cycle is a longest run of
delinquent days without a gap; days after the run date are not looked at, so the last
cycle of an account that is still past due on the run date is open. The current cycle of an
account is its last one. Rows without an account or day belong to none.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.operators import calls as CL
from arrearly.operators import daybits as DB
from arrearly.operators.nullsafe import KEY
from arrearly.params import Params


def _upto(c: str, p: Params) -> Column:
    """c on or before the run date, on the raw column (pushed to the scan)."""
    return F.col(c) < F.lit(p.as_of + dt.timedelta(days=1))


def cycle_runs(bucket: DataFrame, p: Params) -> DataFrame:
    """Runs of delinquent days inside each chunk of 64 days: (account, first,
    last, highest_dpd, early_last), days as numbers; early_last is the last day with a
    DPD of the early range.

    An account's days are bit masks per chunk, as are the days with a DPD in the early
    range and above it, so any number of rows is one fixed row per map task and a
    long history is spread over its chunks. Run borders are the bits without a neighbour; no
    window passes over an account's rows. Only ``highest_dpd`` needs the DPD of
    each day: the distinct (day, DPD) pairs, collected with map-side combine. Who does
    not select it does not collect them (the column is pruned).
    """
    number = DB.day_number(C.day("bucketDate"))
    lo, hi = p.early_dpd
    none = F.lit(0).cast("bigint")
    day, dpd = F.col("day"), F.col("dpd")
    held = (
        bucket.where(F.col(KEY).isNotNull() & (F.col("Max_current_DPD") > 0) & _upto("bucketDate", p))
        .select(KEY, number.alias("day"), F.col("Max_current_DPD").alias("dpd"))
        .groupBy(KEY, DB.chunk_of(day).alias("chunk"))
        .agg(
            F.bit_or(DB.bit_of(day)).alias("days"),
            # A day's DPD is the highest of its rows: the early rule asks for days whose highest is early.
            F.coalesce(F.bit_or(F.when(dpd.between(lo, hi), DB.bit_of(day))), none).alias("early"),
            F.coalesce(F.bit_or(F.when(dpd > hi, DB.bit_of(day))), none).alias("over"),
            F.collect_set(dpd.cast("bigint") * DB.DAYS + F.pmod(day, F.lit(DB.DAYS))).alias("pairs"),
        )
    )
    days = F.col("days")
    from_, to = F.col("run.from"), F.col("run.to")
    begins = DB.places(days.bitwiseAND(F.bitwise_not(F.shiftleft(days, 1)))).alias("from")
    ends = DB.places(days.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(days, 1)))).alias("to")
    runs = held.select(KEY, "chunk", "early", "over", "pairs", F.explode(F.arrays_zip(begins, ends)).alias("run"))
    early = F.col("early").bitwiseAND(F.bitwise_not("over")).bitwiseAND(DB.places_between(from_, to))
    own = F.filter("pairs", lambda x: F.pmod(x, F.lit(DB.DAYS)).between(from_, to))
    start = F.col("chunk") * DB.DAYS
    return runs.select(
        KEY, (start + from_).alias("first"), (start + to).alias("last"),
        F.floor(F.array_max(own) / DB.DAYS).cast("int").alias("highest_dpd"), (start + DB.highest(early)).alias("early_last"))


def cycles(bucket: DataFrame, p: Params) -> DataFrame:
    """(account, cycle_start, cycle_end, highest_dpd, early_end, is_open) of every
    cycle. early_end is the cycle's last day with an early DPD (NULL if it has none);
    a cycle is open if it holds the run date.

    Bucket rows are shuffled once, aggregated to masks (and pairs, for ``highest_dpd``); what is stitched per account
    afterwards are runs, at most a few per chunk of 64 days."""
    runs = cycle_runs(bucket, p)
    by_day = Window.partitionBy(KEY).orderBy("first")
    begins = F.coalesce(F.col("first") > F.lag("last").over(by_day) + 1, F.lit(True))
    stitched = (
        runs.withColumn("_begins", begins.cast("int"))
        .withColumn("_cycle", F.sum("_begins").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(KEY, "_cycle")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("highest_dpd").alias("highest_dpd"),
             F.max("early_last").alias("early_last"))
    )
    return stitched.select(
        KEY, F.date_from_unix_date("first").alias("cycle_start"), F.date_from_unix_date("last").alias("cycle_end"), "highest_dpd",
        F.date_from_unix_date("early_last").alias("early_end"),
        (F.date_from_unix_date("last") == F.lit(p.as_of)).alias("is_open"),
    )


def current_cycles(bucket: DataFrame, p: Params, columns: tuple[str, ...] = ("cycle_end", "highest_dpd", "early_end", "is_open")) -> DataFrame:
    """The last cycle of each account: its start and the ``columns`` asked for."""
    last = F.max(F.struct("cycle_start", *columns)).alias("c")
    return cycles(bucket, p).groupBy(KEY).agg(last).select(KEY, "c.*")


def cycle_attempts(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """(account, cycle_start, early_end, attempt_days): the distinct days of the
    current cycle's early part, its start to its last day with an early DPD, on
    which a queue call was made. Accounts without such a day are not returned.

    Call days are bit masks per (account, 64 days), built map-side; each meets the
    one current cycle of its account, so the interval join makes no pairs
    of calls and days, and days are counted by bits."""
    called = DB.day_sets(CL.queue_calls(calls, p).where(_upto("callDatetime", p)), KEY, C.day("callDatetime"))
    inside = DB.days_between(F.col("days"), F.col("chunk"), F.col("cycle_start"), F.col("early_end"))
    return (
        called.join(current_cycles(bucket, p, ("early_end",)).where(F.col("early_end").isNotNull()), KEY, "inner")
        .groupBy(KEY, "cycle_start", "early_end").agg(F.sum(inside).alias("attempt_days"))
        .where(F.col("attempt_days") > 0)
    )


def attempts_over(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Accounts with more than ``p.min_early_attempts`` day-attempts in the early
    part of their current cycle."""
    return cycle_attempts(calls, bucket, p).where(F.col("attempt_days") > p.min_early_attempts)


def promise_days(calls: DataFrame, p: Params) -> DataFrame:
    """The distinct promise days of queue calls up to the run date, per account."""
    return (
        CL.queue_calls(calls, p)
        .where(F.col("PTP_Date").isNotNull() & _upto("PTP_Date", p))
        .select(KEY, C.day("PTP_Date").alias("promise_day")).distinct()
    )


def promise_cycles(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """(account, promise_day, cycle_start, in_cycle, in_current): for each promise
    day the latest cycle that starts on or before it (a start on the same day counts),
    whether that cycle still ran on the day, and whether the day is in [start of the
    current cycle, run date]. Without an earlier cycle, cycle_start is NULL and both
    flags are false.

    As-of match: cycle starts and promise days are one stream per account, sorted
    by day (starts first), and the last start seen is carried along; no
    promise meets a cycle other than its own. Both sides are distinct days, so a hot
    account has at most two rows a day."""
    starts = cycles(bucket, p).select(
        KEY, F.col("cycle_start").alias("day"), F.lit(0).alias("kind"), F.struct("cycle_start", "cycle_end").alias("cycle"))
    asked = promise_days(calls, p).select(
        KEY, F.col("promise_day").alias("day"), F.lit(1).alias("kind"), F.lit(None).cast(starts.schema["cycle"].dataType).alias("cycle"))
    order = Window.partitionBy(KEY).orderBy("day", "kind")
    carried = F.last("cycle", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # The current cycle is the last start of the account; starts are the only rows with a cycle.
    current = F.max(F.col("cycle")["cycle_start"]).over(Window.partitionBy(KEY))
    merged = starts.unionByName(asked).withColumn("_own", carried).withColumn("_current", current).where(F.col("kind") == 1)
    no = F.lit(False)
    return merged.select(
        KEY, F.col("day").alias("promise_day"), F.col("_own")["cycle_start"].alias("cycle_start"),
        F.coalesce(F.col("day") <= F.col("_own")["cycle_end"], no).alias("in_cycle"),
        F.coalesce(F.col("day") >= F.col("_current"), no).alias("in_current"))


def promised_in_current(calls: DataFrame, bucket: DataFrame, p: Params) -> DataFrame:
    """Accounts with a promise day since the start of their current cycle."""
    return promise_cycles(calls, bucket, p).where(F.col("in_current")).select(KEY).distinct()
