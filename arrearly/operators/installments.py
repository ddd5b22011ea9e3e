"""Installment-schedule operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly import params as P
from arrearly.functions import columns as C
from arrearly.operators.nullsafe import KEY
from arrearly.params import Params


def paid_rows(inst: DataFrame, p: Params) -> DataFrame:
    """Installments whose payment date (missing = far-future sentinel) falls in
    the trailing window. NULL accounts are kept on purpose: the set is used
    unguarded in NOT IN, where one NULL key empties the result."""
    return inst.where(C.trailing_window_with_sentinel("lastPaymentDate", p.as_of, p.paid_days))


def paid_recently(inst: DataFrame, p: Params) -> DataFrame:
    """Distinct accounts (NULL included) with a payment in the window."""
    return paid_rows(inst, p).select(KEY).distinct()


def due_rows(inst: DataFrame, p: Params) -> DataFrame:
    return inst.where(F.col("installmentDueDate") <= F.lit(p.as_of))


def latest_due_keys(inst: DataFrame, p: Params) -> DataFrame:
    """Per account: latest due date and highest installment number among rows
    due by the run date. The two maxima are independent of each other."""
    return due_rows(inst, p).groupBy(KEY).agg(
        F.max("installmentDueDate").alias("latestinstallmentduedate"),
        F.max("installmentNumber").alias("latestinstallmentnumber"),
    )


def latest_installment(inst: DataFrame, p: Params) -> DataFrame:
    """Installment rows that carry both maxima of their account.

    Equi-join on (account, due date, number): rows of one hot account spread
    over many shuffle partitions by their (due date, number), and only the
    one matching pair meets the single key row.
    """
    keys = latest_due_keys(inst, p).select(
        KEY,
        F.col("latestinstallmentduedate").alias("installmentDueDate"),
        F.col("latestinstallmentnumber").alias("installmentNumber"),
    )
    return inst.join(keys, [KEY, "installmentDueDate", "installmentNumber"], "inner")


def _not_partial():
    return (F.coalesce(F.col("directDebitStatus"), F.lit("NA")) != F.lit(P.PARTIAL_PAYMENT_STATUS)).cast("int")


# (due day, installment number, not-partial) packed into one ordered bigint so
# that "the latest row" is a plain max(): a HashAggregate with map-side
# partial aggregation instead of a sort-based aggregate over a struct.
# Layout: day * 2^34 + code(number) * 2 + not_partial, where code(NULL) = 0 and
# code(n) = n + 2^31 + 1, so NULL numbers sort lowest and never match.
_NUM_BIAS = (1 << 31) + 1
_DAY_SHIFT = 1 << 34


def _number_code(n):
    return F.coalesce(n.cast("bigint") + F.lit(_NUM_BIAS), F.lit(0).cast("bigint"))


def latest_row_rank(due, number, not_partial):
    """Ordered bigint code of (due day, number, not-partial flag)."""
    day = F.unix_date(due).cast("bigint")
    return day * F.lit(_DAY_SHIFT) + _number_code(number) * F.lit(2) + not_partial.cast("bigint")


def latest_row_flags(top, max_number):
    """From max(latest_row_rank) and max(number): (both maxima on one row,
    that row not partial)."""
    top_number = F.pmod(top, F.lit(_DAY_SHIFT)).bitwiseAND(F.lit(-2))
    both = max_number.isNotNull() & F.coalesce(top_number == _number_code(max_number) * F.lit(2), F.lit(False))
    return both, both & (F.pmod(top, F.lit(2)) == 1)


def latest_state(inst: DataFrame, p: Params) -> DataFrame:
    """One aggregation per account (no self-join) deciding whether a row with
    both maxima exists and whether one such row is not a partial payment.

    The maximum of latest_row_rank is the row with the latest due date, then
    the highest number on that date, then not-partial if any such row is.
    Both maxima sit on one row exactly when that number equals the overall
    maximum number.
    """
    agg = due_rows(inst, p).groupBy(KEY).agg(
        F.max("installmentNumber").alias("_maxnum"),
        F.max(latest_row_rank(F.col("installmentDueDate"), F.col("installmentNumber"), _not_partial())).alias("_top"),
    )
    both, not_partial = latest_row_flags(F.col("_top"), F.col("_maxnum"))
    return agg.select(KEY, both.alias("has_latest_row"), not_partial.alias("latest_not_partial"))


def latest_not_partial(inst: DataFrame, p: Params) -> DataFrame:
    """Accounts whose latest row (both maxima) is not PARTIALPAYMENT. The rule
    excludes these accounts from Segments A and B, so a loan stays eligible
    only when its latest row *is* a partial payment or no such row exists."""
    return latest_state(inst, p).where(F.col("latest_not_partial")).select(KEY)


def min_unpaid_installment(inst: DataFrame) -> DataFrame:
    """Lowest installment number still delinquent, per account."""
    return (
        inst.where(F.col("isCurrentDelinquent") == 1)
        .groupBy(KEY)
        .agg(F.min("installmentNumber").alias("minunpaidinstallmentnumber"))
    )
