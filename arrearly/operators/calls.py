"""Call-log operators: key sets and per-account facts derived from calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.operators.nullsafe import KEY, key_set
from arrearly.params import Params


def _acct():
    return F.col(KEY)


def queue_filter(p: Params):
    """Calls of the collection queues with a known phone number."""
    return F.col("mobileNumber").isNotNull() & F.col("campaignName").isin(list(p.queue_campaigns))


def not_connected():
    """connected = 0 or missing, on the raw column so that it is pushed down."""
    return F.col("connected").isNull() | (F.col("connected") == 0)


def queue_calls(calls: DataFrame, p: Params) -> DataFrame:
    """Queue calls whose account and phone are both known."""
    return calls.where(queue_filter(p) & _acct().isNotNull())


def kept_promise_rows(calls: DataFrame, p: Params) -> DataFrame:
    return queue_calls(calls, p).where(
        (F.col("PTP_Kept") == 1) & C.trailing_window("Payment_Receiving_Date", p.as_of, p.kept_promise_days)
    )


def kept_ptp(calls: DataFrame, p: Params) -> DataFrame:
    """Accounts with a kept promise paid within the trailing window."""
    return key_set(kept_promise_rows(calls, p))


def unconnected_recent(calls: DataFrame, p: Params) -> DataFrame:
    """Accounts with an unconnected call (connected = 0, null excluded) in the
    trailing window, any campaign, phone known."""
    return key_set(
        calls.where(
            (F.col("connected") == 0)
            & F.col("mobileNumber").isNotNull()
            & _acct().isNotNull()
            & C.trailing_window("callDatetime", p.as_of, p.unconnected_days)
        )
    )


def refusals(calls: DataFrame, p: Params | None = None) -> DataFrame:
    """Accounts with an unconnected call flagged as a refusal, at any date."""
    return key_set(
        calls.where(
            (F.col("connected") == 0) & F.col("mobileNumber").isNotNull() & _acct().isNotNull() & C.is_refusal()
        )
    )


def unconnected_or_refused(calls: DataFrame, p: Params) -> DataFrame:
    """The union of ``unconnected_recent`` and ``refusals`` from one scan."""
    return key_set(
        calls.where(
            (F.col("connected") == 0) & F.col("mobileNumber").isNotNull() & _acct().isNotNull()
            & (C.trailing_window("callDatetime", p.as_of, p.unconnected_days) | C.is_refusal())
        )
    )


def no_contact(calls: DataFrame, p: Params) -> DataFrame:
    """Accounts with a call of a contact campaign that did not connect
    (connected 0 or missing). Connected calls do not disqualify. NULL
    accounts are left out: they can never satisfy IN."""
    return key_set(
        calls.where(
            F.col("campaignName").isin(list(p.contact_campaigns))
            & not_connected()
            & _acct().isNotNull()
        )
    )


def disposition_tags(calls: DataFrame) -> DataFrame:
    """Per call: any-party (APC), right-party (RPC) and third-party (TPC) tags."""
    return calls.select(
        "customerId", KEY, "callDatetime", "campaignName", "genesysWrapupDisposition",
        C.apc().alias("APC"), C.rpc().alias("RPC"), C.tpc().alias("TPC"),
    )


def last_rpc(calls: DataFrame, p: Params) -> DataFrame:
    """Last day with a right-party contact on a queue call, per account."""
    return (
        calls.where(queue_filter(p) & _acct().isNotNull() & (C.rpc() == 1))
        .groupBy(KEY)
        .agg(F.max(C.day("callDatetime")).alias("lastrpcdate"))
        .select(KEY, F.lit(1).alias("RPC"), "lastrpcdate")
    )


def last_ptp(calls: DataFrame, p: Params) -> DataFrame:
    """Latest promise-to-pay date on a queue call, per account."""
    return (
        calls.where(queue_filter(p) & F.col("PTP_Date").isNotNull() & _acct().isNotNull())
        .groupBy(KEY)
        .agg(F.max("PTP_Date").alias("lastptpdate"))
    )


def calls_per_day(calls: DataFrame, p: Params) -> DataFrame:
    """Queue calls counted per (account, call day): the call side of the
    same-day call x bucket match, aggregated before any shuffle."""
    return (
        queue_calls(calls, p)
        .groupBy(KEY, C.day("callDatetime").alias("day"))
        .agg(F.count(F.lit(1)).alias("calls"))
    )
