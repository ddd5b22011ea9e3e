"""Registered queries: one Spark callable and one oracle SQL statement per key.

Every query reads the driver tables of ``sf_dir`` (through the fixture
rules) and runs over all of their rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearly import schemas
from arrearly.functions import columns as C
from arrearly.operators import buckets as BK
from arrearly.operators import calls as CL
from arrearly.operators import campaigns as CG
from arrearly.operators import contacts as CT
from arrearly.operators import cycles as CY
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators import segments as SG
from arrearly.operators import stated as ST
from arrearly.operators.nullsafe import KEY, key_set, not_in, semi
from arrearly.operators.profile import profile
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.plans import fused, report
from arrearly.plans.by_dates import report_by_dates, staged_report
from arrearly.plans.oracle import PRODUCT_SQL, by_dates, with_rules
from arrearly.plans.oracle import in_list as _in
from arrearly.session import scratch_path
from arrearly.sources import by_day, sinks
from arrearly.sources.tables import LoanTables

Query = Callable[[SparkSession, str], DataFrame]
P0 = Params.of(FIXTURE_AS_OF)


def _t(spark: SparkSession, sf_dir: str) -> LoanTables:
    return LoanTables.from_fixtures(spark, sf_dir)


def _q(fn) -> Query:
    """Adapt fn(tables, params) to the (spark, sf_dir) contract."""
    return lambda spark, sf_dir: fn(_t(spark, sf_dir), P0)


# -- sinks: write the report, read it back ------------------------------------

NULL_MARK = "\\N"

# Text that a CSV can break, by customer: blanks at the ends, quote and separator,
# line end, backslash, the empty string. Written the same in Spark and SQL.
AWKWARD_PROVINCE = """CASE customerId % 6
  WHEN 0 THEN concat('  ', province, ' ')
  WHEN 1 THEN concat('"', province, '", x')
  WHEN 2 THEN concat(province, chr(10), 'line two')
  WHEN 3 THEN concat(chr(92), province, chr(92))
  WHEN 4 THEN substr(province, 1, 0) ELSE province END"""


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fused.delinquency_report_fused(_t(spark, sf_dir), P0).withColumn("province", F.expr(AWKWARD_PROVINCE))
    path = scratch_path(spark, "report-csv")
    sinks.export_csv(sinks.for_file(df), path, null_value=NULL_MARK)
    return sinks.read_csv(spark, path, schemas.REPORT, null_value=NULL_MARK)


def _table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The script flow: drop the table, create it, export from the table."""
    path = scratch_path(spark, "report-table")
    name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    sinks.drop_table(spark, name)
    sinks.write_table(fused.delinquency_report_fused(_t(spark, sf_dir), P0), name, path=f"{path}-files")
    sinks.export_csv(sinks.for_file(spark.table(name)), path, null_value=NULL_MARK)
    sinks.drop_table(spark, name)
    return sinks.read_csv(spark, path, schemas.REPORT, null_value=NULL_MARK)


def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fused.delinquency_report_fused(_t(spark, sf_dir), P0)
    root = scratch_path(spark, "report-raw")
    path = sinks.write_raw_dataset(df, root)
    return spark.read.parquet(path)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    root = scratch_path(spark, "report-snapshots")
    earlier = Params.of("2024-01-31")
    sinks.write_snapshot(fused.delinquency_report_fused(t, earlier), root, earlier)
    sinks.write_snapshot(fused.delinquency_report_fused(t, P0), root, P0)
    sinks.write_snapshot(fused.delinquency_report_fused(t, P0), root, P0)  # re-run: same partition replaced
    return sinks.read_snapshot(spark, root, P0)


# Run dates of one job: month ends, mid-month, the fixture day and a later one.
RUN_DATES = tuple(dt.date.fromisoformat(d) for d in (
    "2023-11-30", "2023-12-31", "2024-01-15", "2024-01-31", FIXTURE_AS_OF.isoformat(), "2024-02-29"))


def _snapshot_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All run dates by one job, over folders that hold rows of an earlier run."""
    t = _t(spark, sf_dir)
    root = scratch_path(spark, "report-many")
    sinks.write_snapshots(report_by_dates(t, P0, RUN_DATES[:2]).limit(7), root, RUN_DATES[:2])
    with staged_report(t, P0, RUN_DATES, scratch_path(spark, "report-rows")) as rows:
        sinks.write_snapshots(rows, root, RUN_DATES, spread=True)
    return sinks.read_snapshot(spark, root)


def _calls_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "calls-by-day")
    by_day.write_by_day(_t(spark, sf_dir).calls, root, "calls")
    return by_day.read_days(spark, root, "calls")


def _unconnected_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "calls-by-day")
    by_day.write_by_day(_t(spark, sf_dir).calls, root, "calls")
    return CL.unconnected_recent(by_day.read_trailing(spark, root, "calls", P0.as_of, P0.unconnected_days), P0)


def _campaign_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CG.campaign_group_calls(_t(spark, sf_dir).calls, CG.groups_of(spark, P0))


def _stated_contacts(t: LoanTables, p: Params) -> DataFrame:
    return ST.with_one_contact(LN.loans_base(t.loan_master), t.contacts).select(
        "customerId", KEY, "mobileNo", "contact_number", "primary_number")


def _date_windows(t: LoanTables, p: Params) -> DataFrame:
    return t.calls.select(
        "callDatetime",
        C.day("callDatetime").alias("call_day"),
        C.trailing_window("callDatetime", p.as_of, p.unconnected_days).alias("in_unconnected_window"),
        F.coalesce(C.trailing_window("Payment_Receiving_Date", p.as_of, p.kept_promise_days), F.lit(False))
        .alias("payment_in_kept_window"),
    )


QUERIES: dict[str, Query] = {
    # sources
    "src_loan_master": _q(lambda t, p: t.loan_master),
    "src_calls": _q(lambda t, p: t.calls),
    "src_installments": _q(lambda t, p: t.installments),
    "src_bucket_flow": _q(lambda t, p: t.bucket_flow),
    "src_contacts": _q(lambda t, p: t.contacts),
    # loan master
    "loans_base": _q(lambda t, p: LN.loans_base(t.loan_master)),
    "product_class": _q(lambda t, p: LN.with_product(t.loan_master)),
    "dpd_band_counts": _q(lambda t, p: LN.dpd_band_counts(t.loan_master, p)),
    "early_default_loans": _q(lambda t, p: LN.early_default_loans(t.loan_master)),
    "client_name": _q(lambda t, p: t.loan_master.select(KEY, C.client_name().alias("clientName"))),
    "scalar_null_math": _q(lambda t, p: t.loan_master.select(
        KEY, C.dpd().alias("dpd"), C.total_overdue().alias("total_overdue_amount"),
        C.total_outstanding().alias("total_outstanding_amount"))),
    "account_key_text": _q(lambda t, p: t.loan_master.select(KEY).unionByName(t.calls.select(KEY)).select(
        KEY, C.key_text(KEY).alias("account_text"), C.key_text_file(KEY).alias("account_file_text"))),
    # calls
    "queue_calls": _q(lambda t, p: CL.queue_calls(t.calls, p).select(
        "customerId", KEY, "mobileNumber", "campaignName", "callDatetime")),
    "disposition_tags": _q(lambda t, p: CL.disposition_tags(t.calls)),
    "kept_ptp_60d": _q(lambda t, p: CL.kept_ptp(t.calls, p)),
    "unconnected_30d": _q(lambda t, p: CL.unconnected_recent(t.calls, p)),
    "refusal_loans": _q(lambda t, p: CL.refusals(t.calls, p)),
    "no_contact_loans": _q(lambda t, p: CL.no_contact(t.calls, p)),
    "last_rpc": _q(lambda t, p: CL.last_rpc(t.calls, p)),
    "last_ptp": _q(lambda t, p: CL.last_ptp(t.calls, p)),
    "date_windows": _q(_date_windows),
    # installments
    "paid_60d": _q(lambda t, p: IN.paid_recently(t.installments, p)),
    "latest_due_keys": _q(lambda t, p: IN.latest_due_keys(t.installments, p)),
    "latest_installment": _q(lambda t, p: IN.latest_installment(t.installments, p)),
    "latest_not_partial": _q(lambda t, p: IN.latest_not_partial(t.installments, p)),
    "min_unpaid_installment": _q(lambda t, p: IN.min_unpaid_installment(t.installments)),
    # buckets, calls x buckets
    "bucket_entry": _q(lambda t, p: BK.bucket_entry(t.bucket_flow, p)),
    "early_dpd_days": _q(lambda t, p: BK.early_dpd_days(t.bucket_flow, p)),
    "ptp_since_bucket": _q(lambda t, p: BK.ptp_since_bucket(t.calls, t.bucket_flow, p)),
    "call_bucket_days": _q(lambda t, p: BK.call_bucket_days(t.calls, t.bucket_flow, p)),
    "attempts_over_10": _q(lambda t, p: BK.early_dpd_attempts(t.calls, t.bucket_flow, p)
                           .where(F.col("attempts") > p.min_early_attempts)),
    # contacts
    "contact_rank": _q(lambda t, p: CT.contact_rank(t.contacts)),
    # membership joins
    "semi_early_default": _q(lambda t, p: semi(LN.in_dpd_band(t.loan_master, p.band_a),
                                               LN.early_default_loans(t.loan_master)).select(KEY)),
    "no_contact_or_refusal": _q(lambda t, p: semi(
        LN.in_dpd_band(t.loan_master, p.band_b), CL.unconnected_or_refused(t.calls, p)).select(KEY)),
    "anti_paid_60d": _q(lambda t, p: not_in(LN.in_dpd_band(t.loan_master, p.band_c),
                                            IN.paid_recently(t.installments, p)).select(KEY)),
    "null_aware_anti": _q(lambda t, p: not_in(key_set(t.calls), IN.paid_recently(t.installments, p))),
    # segments and report
    "segment_c": _q(SG.segment_c),
    "segment_b": _q(SG.segment_b),
    "segment_a": _q(SG.segment_a),
    "segment_label": _q(lambda t, p: SG.label_segment(
        LN.loans_base(t.loan_master).select(KEY), *SG.segment_keys(t, p))),
    "segment_label_fused": _q(lambda t, p: LN.loans_base(t.loan_master).select(KEY)
                              .join(fused.segment_labels(t, p), KEY, "left")
                              .select(KEY, F.coalesce("Segment", F.lit("NA")).alias("Segment"))),
    "account_facts": _q(fused.account_facts),
    "early_dpd_attempts": _q(lambda t, p: BK.early_dpd_attempts(t.calls, t.bucket_flow, p)),
    "delinquency_report": _q(fused.delinquency_report_fused),
    "delinquency_report_stepwise": _q(report.delinquency_report),
    "delinquency_report_fused": _q(fused.delinquency_report_fused),
    "delinquency_report_v0": _q(fused.delinquency_report_v0),
    "profile_report": _q(lambda t, p: profile(fused.delinquency_report_fused(t, p))),
    "report_by_dates": _q(lambda t, p: report_by_dates(t, p, RUN_DATES)),
    # rules as stated
    "stated_cycles": _q(lambda t, p: CY.cycles(t.bucket_flow, p)),
    "stated_attempts": _q(lambda t, p: CY.cycle_attempts(t.calls, t.bucket_flow, p).select(
        "*", (F.col("attempt_days") > p.min_early_attempts).alias("enough"))),
    "stated_ptp_in_cycle": _q(lambda t, p: CY.promise_cycles(t.calls, t.bucket_flow, p)),
    "stated_segment_b_contact": _q(lambda t, p: ST.segment_b_contact(t.loan_master, t.calls, p)),
    "stated_no_contact": _q(lambda t, p: ST.no_contact_since_disbursement(t.loan_master, t.calls, p)),
    "stated_contacts": _q(_stated_contacts),
    "stated_segments": _q(ST.segment_labels),
    "stated_report": _q(report.delinquency_report_stated),
    # campaign groups as data, inputs by day
    "campaign_group_calls": _campaign_groups,
    "src_calls_by_day": _calls_by_day,
    "unconnected_30d_by_day": _unconnected_by_day,
    # sinks
    "sink_csv_roundtrip": _csv_roundtrip,
    "sink_parquet_roundtrip": _parquet_roundtrip,
    "sink_table_roundtrip": _table_roundtrip,
    "snapshot_by_as_of": _snapshot,
    "snapshot_many_dates": _snapshot_many,
}


def _profile_sql() -> str:
    parts = []
    for i, f in enumerate(schemas.REPORT.fields):
        parts.append(
            f"SELECT {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
            f"CAST(count({f.name}) AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS rows FROM report"
        )
    return "\nUNION ALL\n".join(parts)


_REPORT_COLS = ", ".join(schemas.REPORT_COLUMNS)
_REPORT_V0_COLS = ", ".join(schemas.REPORT_V0_COLUMNS)


def _file_columns(new: dict[str, str]) -> str:
    """The report's columns as files have them: a missing account is 'None'."""
    new = {"loanAccountNumber": "coalesce(loanAccountNumber, 'None')"} | new
    return ", ".join(f"{new[c]} AS {c}" if c in new else c for c in schemas.REPORT_COLUMNS)


_SELECTS: dict[str, str] = {
    "src_loan_master": "SELECT * FROM loan_master",
    "src_calls": "SELECT * FROM calls",
    "src_installments": "SELECT * FROM installments",
    "src_bucket_flow": "SELECT * FROM bucket_flow",
    "src_contacts": "SELECT * FROM contacts",
    "loans_base": "SELECT * FROM base",
    "product_class": f"SELECT loanAccountNumber, loanType, purpleKey, isUserAtStore, {PRODUCT_SQL} AS Product "
                     "FROM loan_master",
    "dpd_band_counts": f"""SELECT band, CAST(count(*) AS BIGINT) AS loans FROM (
        SELECT CASE WHEN coalesce(currentDelinquency, 0) > {P0.band_a[0]} AND coalesce(currentDelinquency, 0) <= {P0.band_a[1]} THEN 'A'
                    WHEN coalesce(currentDelinquency, 0) > {P0.band_b[0]} AND coalesce(currentDelinquency, 0) <= {P0.band_b[1]} THEN 'B'
                    WHEN coalesce(currentDelinquency, 0) > {P0.band_c[0]} THEN 'C'
                    ELSE 'none' END AS band
        FROM loan_master) GROUP BY band""",
    "early_default_loans": "SELECT loanAccountNumber FROM early_default",
    "client_name": "SELECT loanAccountNumber, firstName || ' ' || middleName || ' ' || lastName AS clientName "
                   "FROM loan_master",
    "scalar_null_math": """SELECT loanAccountNumber, coalesce(currentDelinquency, 0) AS dpd,
        coalesce(Overdue_Principal, 0) + coalesce(Overdue_Interest, 0) + coalesce(Overdue_Penalty, 0) AS total_overdue_amount,
        coalesce(Total_Outstanding_Principal, 0) + coalesce(Total_Outstanding_Interest, 0) + Total_Outstanding_Penalty
          AS total_outstanding_amount
        FROM loan_master""",
    "account_key_text": "SELECT loanAccountNumber, CAST(loanAccountNumber AS VARCHAR) AS account_text, "
                        "coalesce(CAST(loanAccountNumber AS VARCHAR), 'None') AS account_file_text FROM "
                        "(SELECT loanAccountNumber FROM loan_master UNION ALL SELECT loanAccountNumber FROM calls)",
    "queue_calls": "SELECT customerId, loanAccountNumber, mobileNumber, campaignName, callDatetime FROM qcalls",
    "disposition_tags": "SELECT customerId, loanAccountNumber, callDatetime, campaignName, genesysWrapupDisposition, "
                        "APC, RPC, TPC FROM tags",
    "kept_ptp_60d": "SELECT * FROM kept",
    "unconnected_30d": "SELECT * FROM unconnected",
    "refusal_loans": "SELECT * FROM refused",
    "no_contact_loans": "SELECT DISTINCT loanAccountNumber FROM nocontact WHERE loanAccountNumber IS NOT NULL",
    "last_rpc": "SELECT * FROM rpc",
    "last_ptp": "SELECT * FROM ptp",
    "date_windows": f"""SELECT callDatetime, CAST(callDatetime AS DATE) AS call_day,
        CAST(callDatetime AS DATE) BETWEEN DATE '{P0.as_of_iso}' - {P0.unconnected_days} AND DATE '{P0.as_of_iso}'
          AS in_unconnected_window,
        coalesce(CAST(Payment_Receiving_Date AS DATE) BETWEEN DATE '{P0.as_of_iso}' - {P0.kept_promise_days}
                 AND DATE '{P0.as_of_iso}', false) AS payment_in_kept_window
        FROM calls""",
    "paid_60d": "SELECT * FROM paid",
    "latest_due_keys": "SELECT * FROM due_max",
    "latest_installment": "SELECT * FROM latest_rows",
    "latest_not_partial": "SELECT DISTINCT loanAccountNumber FROM not_partial",
    "min_unpaid_installment": "SELECT * FROM unpaid",
    "bucket_entry": "SELECT * FROM entry",
    "early_dpd_days": "SELECT * FROM early_days",
    "ptp_since_bucket": "SELECT * FROM promised",
    "call_bucket_days": """SELECT c.loanAccountNumber, c.day, c.calls, b.bucket_rows,
          CAST(c.calls * b.bucket_rows AS BIGINT) AS matches
        FROM (SELECT loanAccountNumber, CAST(callDatetime AS DATE) AS day, CAST(count(*) AS BIGINT) AS calls
              FROM qcalls GROUP BY 1, 2) c
        JOIN (SELECT loanAccountNumber, CAST(bucketDate AS DATE) AS day, CAST(count(*) AS BIGINT) AS bucket_rows
              FROM early_days GROUP BY 1, 2) b
          ON c.loanAccountNumber = b.loanAccountNumber AND c.day = b.day""",
    "attempts_over_10": "SELECT * FROM attempts_over",
    "contact_rank": "SELECT customer_id, new_mobile_number, change_date, CAST(rnk AS BIGINT) AS rnk FROM cd",
    "semi_early_default": f"""SELECT loanAccountNumber FROM loan_master
        WHERE coalesce(currentDelinquency, 0) > {P0.band_a[0]} AND coalesce(currentDelinquency, 0) <= {P0.band_a[1]}
          AND loanAccountNumber IN (SELECT loanAccountNumber FROM early_default)""",
    "no_contact_or_refusal": f"""SELECT loanAccountNumber FROM loan_master
        WHERE coalesce(currentDelinquency, 0) > {P0.band_b[0]} AND coalesce(currentDelinquency, 0) <= {P0.band_b[1]}
          AND (loanAccountNumber IN (SELECT loanAccountNumber FROM unconnected)
               OR loanAccountNumber IN (SELECT loanAccountNumber FROM refused))""",
    "anti_paid_60d": f"""SELECT loanAccountNumber FROM loan_master
        WHERE coalesce(currentDelinquency, 0) > {P0.band_c[0]}
          AND loanAccountNumber NOT IN (SELECT loanAccountNumber FROM paid)""",
    "null_aware_anti": """SELECT DISTINCT loanAccountNumber FROM calls
        WHERE loanAccountNumber NOT IN (SELECT loanAccountNumber FROM paid)""",
    "segment_c": "SELECT * FROM seg_c",
    "segment_b": "SELECT * FROM seg_b",
    "segment_a": "SELECT * FROM seg_a",
    "segment_label": "SELECT loanAccountNumber, Segment FROM labelled",
    "segment_label_fused": "SELECT loanAccountNumber, Segment FROM labelled",
    "account_facts": """SELECT a.loanAccountNumber,
          CASE WHEN a.loanAccountNumber IN (SELECT loanAccountNumber FROM seg_a) THEN 'Segment A'
               WHEN a.loanAccountNumber IN (SELECT loanAccountNumber FROM seg_b) THEN 'Segment B'
               WHEN a.loanAccountNumber IN (SELECT loanAccountNumber FROM seg_c) THEN 'Segment C'
               ELSE 'NA' END AS Segment,
          rpc.lastrpcdate, ptp.lastptpdate, unpaid.minunpaidinstallmentnumber
        FROM (SELECT DISTINCT loanAccountNumber FROM loan_master WHERE loanAccountNumber IS NOT NULL) a
        LEFT JOIN rpc ON rpc.loanAccountNumber = a.loanAccountNumber
        LEFT JOIN ptp ON ptp.loanAccountNumber = a.loanAccountNumber
        LEFT JOIN unpaid ON unpaid.loanAccountNumber = a.loanAccountNumber""",
    "early_dpd_attempts": "SELECT * FROM attempts",
    "delinquency_report": f"SELECT {_REPORT_COLS} FROM report",
    "delinquency_report_fused": f"SELECT {_REPORT_COLS} FROM report",
    "delinquency_report_stepwise": f"SELECT {_REPORT_COLS} FROM report",
    "delinquency_report_v0": f"SELECT {_REPORT_V0_COLS} FROM report",
    "profile_report": _profile_sql(),
    "sink_csv_roundtrip": f"SELECT {_file_columns({'province': AWKWARD_PROVINCE})} FROM report",
    "sink_parquet_roundtrip": f"SELECT {_file_columns({})} FROM report",
    "sink_table_roundtrip": f"SELECT {_file_columns({})} FROM report",
    "stated_cycles": "SELECT * FROM cycles",
    "stated_attempts": f"SELECT *, attempt_days > {P0.min_early_attempts} AS enough FROM day_attempts",
    "stated_ptp_in_cycle": "SELECT * FROM promise_cycles",
    "stated_segment_b_contact": "SELECT * FROM b_contact",
    "stated_no_contact": "SELECT * FROM silent",
    "stated_contacts": """SELECT b.customerId, b.loanAccountNumber, b.mobileNo, cd.new_mobile_number AS contact_number,
          CAST(coalesce(b.mobileNo, cd.new_mobile_number) AS VARCHAR) AS primary_number
        FROM base b LEFT JOIN cd ON b.customerId = cd.customer_id AND cd.rnk = 1""",
    "stated_segments": """SELECT loanAccountNumber, CASE WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_a) THEN 'Segment A'
          WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_b) THEN 'Segment B'
          WHEN loanAccountNumber IN (SELECT loanAccountNumber FROM stated_c) THEN 'Segment C' ELSE 'NA' END AS Segment FROM base""",
    "stated_report": f"""SELECT {_REPORT_COLS} FROM (
          SELECT b.customerId, CAST(b.loanAccountNumber AS VARCHAR) AS loanAccountNumber, b.disbursementDateTime, b.clientName, b.province, b.dpd,
                 b.Overdue_Principal, b.Overdue_Interest, b.Overdue_Penalty, b.total_overdue_amount, b.outstandingBalance, b.total_outstanding_amount,
                 b.loanPaidStatus, CAST(coalesce(b.mobileNo, cd.new_mobile_number) AS VARCHAR) AS primary_number,
                 CASE WHEN b.loanAccountNumber IN (SELECT loanAccountNumber FROM stated_a) THEN 'Segment A'
                      WHEN b.loanAccountNumber IN (SELECT loanAccountNumber FROM stated_b) THEN 'Segment B'
                      WHEN b.loanAccountNumber IN (SELECT loanAccountNumber FROM stated_c) THEN 'Segment C' ELSE 'NA' END AS Segment,
                 b.ltype AS Product, b.lastPaidDT, rpc.lastrpcdate, ptp.lastptpdate, unpaid.minunpaidinstallmentnumber
          FROM base b LEFT JOIN cd ON b.customerId = cd.customer_id AND cd.rnk = 1
          LEFT JOIN rpc ON rpc.loanAccountNumber = b.loanAccountNumber LEFT JOIN ptp ON ptp.loanAccountNumber = b.loanAccountNumber
          LEFT JOIN unpaid ON unpaid.loanAccountNumber = b.loanAccountNumber)""",
    "campaign_group_calls": f"""SELECT loanAccountNumber, count(*) FILTER (WHERE campaignName IN ({_in(P0.queue_campaigns)})) AS queue_calls,
          count(*) FILTER (WHERE campaignName IN ({_in(P0.contact_campaigns)})) AS contact_calls,
          count(*) FILTER (WHERE campaignName IN ({_in(P0.contact_campaigns)}) AND coalesce(connected, 0) = 0) AS unconnected_contact_calls
        FROM calls WHERE campaignName IN ({_in((*P0.queue_campaigns, *P0.contact_campaigns))}) GROUP BY loanAccountNumber""",
    "src_calls_by_day": "SELECT * FROM calls",
    "unconnected_30d_by_day": "SELECT * FROM unconnected",
    "snapshot_by_as_of": f"SELECT {_REPORT_COLS}, DATE '{P0.as_of_iso}' AS as_of FROM report",
}

_MANY = by_dates(f"SELECT {_REPORT_COLS}, DATE '{{as_of}}' AS as_of FROM report", P0, RUN_DATES)

ORACLE: dict[str, str] = {k: with_rules(v, P0) for k, v in _SELECTS.items()} | {
    "report_by_dates": _MANY,
    "snapshot_many_dates": _MANY,
}
