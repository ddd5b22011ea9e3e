"""The case report for many run dates from one pass over the inputs.

Only three rules depend on the run date through a trailing window (kept promise,
unconnected call, payment) and two through "up to the run date" (latest due
installment, latest promise). Windows become bit masks: bit i of a row's mask
says that the window of date i holds the row, and ``bit_or`` gathers an account's masks in
the aggregate that the single run has anyway. "Up to" rules are maxima per
slot between two neighbouring dates, made cumulative per account after the aggregation.
No row is copied per date before the report rows themselves, so scans and exchanges
are those of one run; the expansion to dates is the last step.

A pass takes at most ``MOST`` dates, so that its aggregates stay within generated code;
more dates are as many passes.

``report_by_dates`` is lazy: a write of it holds the shuffle files of all its steps until its last
row is written. ``staged_report`` is for such writes: labels, then report rows not yet copied per date, are
kept as files, so that each step's shuffle files go before the next, and the write of the dates, by far the most rows,
shuffles and sorts nothing.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
from collections.abc import Callable, Iterable, Iterator

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
from arrearly.plans import fused
from arrearly.plans.report import attach_contacts, report_columns
from arrearly.session import SHUFFLE_CLEANUP, drop_path, session_conf
from arrearly.sources.tables import LoanTables

MOST = 24
TOTAL = "total_overdue_amount"
LABELS = (P.NO_SEGMENT_LABEL, *P.SEGMENT_LABELS)  # two bits a date


def _any(cond: Column) -> Column:
    return F.coalesce(F.max(F.coalesce(cond, F.lit(False))), F.lit(False))


def _mask(window: Callable[[dt.date], Column], dates: list[dt.date], also: Column | None = None) -> Column:
    """Bits of the dates whose window holds the row; NULL where none does."""
    out = F.lit(0).cast("bigint")
    for i, d in enumerate(dates):
        cond = window(d) if also is None else also & window(d)
        out = out.bitwiseOR(F.when(cond, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def _gather(mask: Column) -> Column:
    return F.coalesce(F.bit_or(mask), F.lit(0).cast("bigint"))


def _bit(mask: Column, i: int) -> Column:
    return F.coalesce(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.lit(False))


def _slots(c: str, dates: list[dt.date]) -> list[Column]:
    """Condition per date: c lies after the date before it and not after it."""
    out = []
    for i, d in enumerate(dates):
        upto = F.col(c) < F.lit(d + dt.timedelta(days=1))
        out.append(upto if not i else upto & (F.col(c) >= F.lit(dates[i - 1] + dt.timedelta(days=1))))
    return out


def _upto(names: list[str]) -> list[Column]:
    """Running maximum over slot columns."""
    return [F.col(names[0]) if not i else F.greatest(*names[: i + 1]) for i in range(len(names))]


def _span(c: str, dates: list[dt.date], days: int) -> Column:
    """c lies in some window: one range on the raw column, pushed to the scan."""
    return C.day_between(c, dates[0] - dt.timedelta(days=days), dates[-1])


def activity_features(calls: DataFrame, bucket: DataFrame, p: Params, dates: list[dt.date]) -> DataFrame:
    """As the single run's, with masks for the windows and ``last_promise_<i>``."""
    queue = CL.queue_filter(p)
    mobile, unconnected = F.col("mobileNumber").isNotNull(), F.col("connected") == 0
    promise = queue & F.col("PTP_Date").isNotNull()
    campaigns = [*p.queue_campaigns, *(c for c in p.contact_campaigns if c not in p.queue_campaigns)]
    of_use = F.col("campaignName").isin(campaigns) | (unconnected & mobile)
    slot = [f"_ptp{i}" for i in range(len(dates))]
    kept = _mask(lambda d: C.trailing_window("Payment_Receiving_Date", d, p.kept_promise_days), dates, queue & (F.col("PTP_Kept") == 1))
    recent = _mask(lambda d: C.trailing_window("callDatetime", d, p.unconnected_days), dates, unconnected & mobile)
    number = DB.day_number(C.day("callDatetime"))
    spans = (
        calls.where(F.col(KEY).isNotNull() & of_use)
        .withColumns({"span": DB.span_of(number), "_slot": F.when(queue, DB.slot_of(number))})
        .groupBy(KEY, "span")
        .agg(
            _gather(kept).alias("kept_promise"), _gather(recent).alias("unconnected_recent"),
            _any(unconnected & mobile & C.is_refusal()).alias("refusal"),
            _any(F.col("campaignName").isin(list(p.contact_campaigns)) & CL.not_connected()).alias("no_contact"),
            F.max(F.when(queue & (C.rpc() == 1), C.day("callDatetime"))).alias("lastrpcdate"),
            F.max(F.when(promise, F.col("PTP_Date"))).alias("lastptpdate"),
            *DB.slot_counts(F.col("_slot"), "queue_calls"),
            *[F.max(F.when(promise & cond, C.day("PTP_Date"))).alias(name) for name, cond in zip(slot, _slots("PTP_Date", dates))],
        )
        .join(fused.bucket_spans(bucket, p), [KEY, "span"], "full")
    )
    facts = spans.groupBy(KEY).agg(
        _gather(F.col("kept_promise")).alias("kept_promise"), _gather(F.col("unconnected_recent")).alias("unconnected_recent"),
        _any(F.col("refusal")).alias("refusal"), _any(F.col("no_contact")).alias("no_contact"),
        F.max("lastrpcdate").alias("lastrpcdate"), F.max("lastptpdate").alias("lastptpdate"), F.min("entry_date").alias("bucket_entry"),
        F.coalesce(F.sum(DB.slot_products("queue_calls", "early_rows")), F.lit(0)).alias("attempts"),
        *[F.max(s).alias(s) for s in slot],
    )
    return facts.select("*", *[c.alias(f"last_promise_{i}") for i, c in enumerate(_upto(slot))]).drop(*slot)


def _paid_mask(p: Params, dates: list[dt.date]) -> Column:
    return _mask(lambda d: C.trailing_window_with_sentinel("lastPaymentDate", d, p.paid_days), dates)


def installment_features(inst: DataFrame, p: Params, dates: list[dt.date]) -> DataFrame:
    """(account, paid, minunpaidinstallmentnumber, not_partial_<i>)."""
    not_partial = (F.coalesce(F.col("directDebitStatus"), F.lit("NA")) != F.lit(P.PARTIAL_PAYMENT_STATUS)).cast("int")
    rank = IN.latest_row_rank(F.col("installmentDueDate"), F.col("installmentNumber"), not_partial)
    slots = _slots("installmentDueDate", dates)
    num, top = [f"_num{i}" for i in range(len(dates))], [f"_top{i}" for i in range(len(dates))]
    due = F.col("installmentDueDate") <= F.lit(dates[-1])
    far = dt.date.fromisoformat(P.NO_PAYMENT_SENTINEL)
    paid = _span("lastPaymentDate", dates, p.paid_days)
    if dates[0] - dt.timedelta(days=p.paid_days) <= far <= dates[-1]:
        paid = paid | F.col("lastPaymentDate").isNull()
    facts = inst.where(F.col(KEY).isNotNull() & (due | paid | (F.col("isCurrentDelinquent") == 1))).groupBy(KEY).agg(
        _gather(_paid_mask(p, dates)).alias("paid"),
        F.min(F.when(F.col("isCurrentDelinquent") == 1, F.col("installmentNumber"))).alias("minunpaidinstallmentnumber"),
        *[F.max(F.when(s, F.col("installmentNumber"))).alias(n) for n, s in zip(num, slots)],
        *[F.max(F.when(s, rank)).alias(n) for n, s in zip(top, slots)],
    )
    flags = [IN.latest_row_flags(t, n)[1].alias(f"not_partial_{i}") for i, (t, n) in enumerate(zip(_upto(top), _upto(num)))]
    return facts.select(KEY, "paid", "minunpaidinstallmentnumber", *flags)


def account_labels(t: LoanTables, p: Params, dates: list[dt.date]) -> DataFrame:
    """(account, labels, lastrpcdate, lastptpdate, minunpaidinstallmentnumber):
    bits 2i and 2i + 1 of labels are the place in ``LABELS`` of the segment on date i, for accounts with a row past due."""
    f = (
        fused.band_features(t.loan_master, p, delinquent_only=True)
        .join(activity_features(t.calls, t.bucket_flow, p, dates), KEY, "left")
        .join(installment_features(t.installments, p, dates), KEY, "left")
    )
    # Dates on which some payment of an unknown account lies in the window: Segment C is empty then.
    unknown_paid = t.installments.where(
        F.col(KEY).isNull() & F.col("lastPaymentDate").isNotNull() & _span("lastPaymentDate", dates, p.paid_days)
    ).agg(_gather(_paid_mask(p, dates)).alias("m"))
    # A payment date missing altogether counts only for run dates around the sentinel.
    far = dt.date.fromisoformat(P.NO_PAYMENT_SENTINEL)
    if dates[0] - dt.timedelta(days=p.paid_days) <= far <= dates[-1]:
        unknown_paid = t.installments.where(F.col(KEY).isNull()).agg(_gather(_paid_mask(p, dates)).alias("m"))
    f = f.withColumn("_unknown_paid", unknown_paid.scalar())
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    labels = F.lit(0).cast("bigint")
    for i in range(len(dates)):
        since = F.coalesce(F.col(f"last_promise_{i}") >= F.col("bucket_entry"), F.lit(False))
        partial = ~yes(f"not_partial_{i}")
        a = (yes("band_a") & yes("early_default") & partial & (F.coalesce(F.col("attempts"), F.lit(0)) > p.min_early_attempts)
             & yes("no_contact"))
        b = yes("band_b") & partial & (_bit(F.col("unconnected_recent"), i) | yes("refusal")) & ~since
        c = yes("band_c") & ~_bit(F.col("kept_promise"), i) & ~_bit(F.col("paid"), i) & ~_bit(F.col("_unknown_paid"), i)
        code = F.when(a, 1).when(b, 2).when(c, 3).otherwise(0).cast("bigint")
        labels = labels.bitwiseOR(F.shiftleft(code, 2 * i))
    return f.select(KEY, labels.alias("labels"), "lastrpcdate", "lastptpdate", "minunpaidinstallmentnumber")


def _rows(t: LoanTables, labels: DataFrame) -> DataFrame:
    """The report rows, once; ``Segment`` holds the labels of all dates. The overdue total does not travel with its parts."""
    df = left_join_known(LN.loans_base(t.loan_master).drop(TOTAL), labels, KEY)
    rows = attach_contacts(df.withColumnRenamed("labels", "Segment"), t.contacts)
    return report_columns(rows.withColumn(TOTAL, C.total_overdue()))


def _label(i: int | Column) -> Column:
    """The segment on date i; a row without account facts has none."""
    place = F.lit(2) * (F.lit(i) if isinstance(i, int) else i)
    code = F.call_function("shiftright", F.col("Segment"), place).bitwiseAND(F.lit(3).cast("bigint"))
    out = None
    for k, label in enumerate(LABELS[1:], 1):
        out = F.when(code == k, label) if out is None else out.when(code == k, label)
    return out.otherwise(LABELS[0])


def _pass(t: LoanTables, p: Params, dates: list[dt.date]) -> DataFrame:
    rows = _rows(t, account_labels(t, p, dates))
    out = rows.select("*", F.posexplode(F.array(*[F.lit(d) for d in dates])).alias("_i", "as_of"))
    return out.withColumn("Segment", _label(F.col("_i"))).select(*schemas.REPORT_COLUMNS, "as_of")


def _passes(p: Params, dates: Iterable[str | dt.date]) -> list[tuple[Params, list[dt.date]]]:
    days = sorted({dt.date.fromisoformat(d) if isinstance(d, str) else d for d in dates})
    if not days:
        raise ValueError("no run dates")
    parts = [days[lo: lo + MOST] for lo in range(0, len(days), MOST)]
    return [(dataclasses.replace(p, as_of=part[-1]), part) for part in parts]


def report_by_dates(t: LoanTables, p: Params, dates: Iterable[str | dt.date]) -> DataFrame:
    """The report of every run date (``p.as_of`` is not used), with a column
    ``as_of``. The same rows as one run per date; a date named twice is one."""
    out = None
    for q, days in _passes(p, dates):
        part = _pass(t, q, days)
        out = part if out is None else out.unionByName(part)
    return out


def _kept(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``df`` from files of the run's own, its shuffle files gone."""
    with session_conf(df.sparkSession, SHUFFLE_CLEANUP):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged_report(t: LoanTables, p: Params, dates: Iterable[str | dt.date], root: str) -> Iterator[DataFrame]:
    """``report_by_dates`` to be written: the rows lie under ``root``, a folder of this call that is
    removed behind it. Each date has tasks of its own, which read the rows and nothing else."""
    spark, out = t.loan_master.sparkSession, None
    root = root.rstrip("/")
    try:
        for k, (q, days) in enumerate(_passes(p, dates)):
            labels = _kept(account_labels(t, q, days), f"{root}/labels-{k}")
            rows = _kept(_rows(t, labels).drop(TOTAL), f"{root}/rows-{k}").withColumn(TOTAL, C.total_overdue())
            drop_path(spark, f"{root}/labels-{k}")
            for i, d in enumerate(days):
                part = rows.withColumns({"Segment": _label(i), "as_of": F.lit(d)}).select(*schemas.REPORT_COLUMNS, "as_of")
                out = part if out is None else out.unionByName(part)
        yield out
    finally:
        drop_path(spark, root)
