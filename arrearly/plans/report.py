"""The case report, step by step: one operator per rule, composed with
membership joins (readable form; ``fused`` is the production form)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly import params as P
from arrearly import schemas
from arrearly.operators import calls as CL
from arrearly.operators import contacts as CT
from arrearly.operators import installments as IN
from arrearly.operators import loans as LN
from arrearly.operators import segments as SG
from arrearly.operators import stated as ST
from arrearly.operators.nullsafe import KEY, left_join_known, left_join_spread
from arrearly.params import Params
from arrearly.sources.tables import LoanTables


def report_columns(df: DataFrame) -> DataFrame:
    """Project a base ⟕ facts ⟕ contacts frame onto the 20 report columns."""
    return df.select(
        "customerId",
        F.col(KEY).cast("string").alias(KEY),
        "disbursementDateTime", "clientName", "province", "dpd",
        "Overdue_Principal", "Overdue_Interest", "Overdue_Penalty", "total_overdue_amount",
        "outstandingBalance", "total_outstanding_amount", "loanPaidStatus",
        F.coalesce(F.col("mobileNo"), F.col("new_mobile_number")).cast("string").alias("primary_number"),
        "Segment",
        F.col("ltype").alias("Product"),
        "lastPaidDT", "lastrpcdate", "lastptpdate", "minunpaidinstallmentnumber",
    )


def attach_contacts(df: DataFrame, contacts: DataFrame) -> DataFrame:
    """Left join of every active contact of the loan's customer: a customer
    with n active contacts yields n rows per loan (none: one row)."""
    cd = CT.active_contacts(contacts).select(F.col("customer_id").alias("customerId"), "new_mobile_number")
    return left_join_spread(df, cd, "customerId", KEY)


def account_dates(t: LoanTables, p: Params) -> DataFrame:
    """Per account: last contact day, last promise and lowest unpaid installment."""
    facts = IN.min_unpaid_installment(t.installments).where(F.col(KEY).isNotNull())
    for more in (CL.last_rpc(t.calls, p).select(KEY, "lastrpcdate"), CL.last_ptp(t.calls, p)):
        facts = facts.join(more, KEY, "full")
    return facts


def delinquency_report(t: LoanTables, p: Params) -> DataFrame:
    base = LN.loans_base(t.loan_master)
    a, b, c = SG.segment_keys(t, p)
    facts = account_dates(t, p)
    known = SG.label_segment(base.where(F.col(KEY).isNotNull()), a, b, c).join(facts, KEY, "left")
    # A loan without an account is in no set and has no facts.
    unknown = base.where(F.col(KEY).isNull()).withColumn("Segment", F.lit(P.NO_SEGMENT_LABEL))
    df = known.unionByName(unknown, allowMissingColumns=True)
    return report_columns(attach_contacts(df, t.contacts))


def delinquency_report_stated(t: LoanTables, p: Params) -> DataFrame:
    """The report by the rules as stated: one row per loan, with one contact number
    of its customer and the stated segments."""
    labelled = ST.label_segment(LN.loans_base(t.loan_master), t, p)
    df = ST.with_one_contact(left_join_known(labelled, account_dates(t, p), KEY), t.contacts)
    return report_columns(df.withColumnRenamed("contact_number", "new_mobile_number").drop("primary_number"))


def delinquency_report_v0(t: LoanTables, p: Params) -> DataFrame:
    """The first report version: the same rows without ``loanPaidStatus``."""
    return delinquency_report(t, p).select(*schemas.REPORT_V0_COLUMNS)
