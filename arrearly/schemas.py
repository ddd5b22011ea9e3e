"""Fixed Spark schemas of the five inputs and of the report."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _S, _D, _DT, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LOAN_MASTER = _struct(
    ("customerId", _L), ("loanAccountNumber", _L), ("disbursementDateTime", _TS),
    ("firstName", _S), ("middleName", _S), ("lastName", _S), ("province", _S),
    ("currentDelinquency", _I),
    ("Overdue_Principal", _D), ("Overdue_Interest", _D), ("Overdue_Penalty", _D),
    ("outstandingBalance", _D), ("Total_Outstanding_Principal", _D),
    ("Total_Outstanding_Interest", _D), ("Total_Outstanding_Penalty", _D),
    ("mobileNo", _L), ("loanType", _S), ("purpleKey", _S), ("isUserAtStore", _I),
    ("lastPaidDT", _TS), ("loanPaidStatus", _S), ("flagDisbursement", _I),
    ("obsFPD00", _I), ("obsSPD00", _I), ("obsTPD00", _I),
)

INSTALLMENTS = _struct(
    ("loanAccountNumber", _L), ("installmentNumber", _I), ("installmentDueDate", _DT),
    ("directDebitStatus", _S), ("lastPaymentDate", _DT), ("isCurrentDelinquent", _I),
)

CALLS = _struct(
    ("customerId", _L), ("loanAccountNumber", _L), ("mobileNumber", _L), ("campaignName", _S),
    ("callDatetime", _TS), ("connected", _I), ("PTP_Date", _DT), ("PTP_Kept", _I),
    ("Payment_Receiving_Date", _DT), ("genesysWrapupDisposition", _S), ("subdisposition", _S),
)

BUCKET_FLOW = _struct(("loanAccountNumber", _L), ("bucketDate", _DT), ("Max_current_DPD", _I))

CONTACTS = _struct(("customer_id", _L), ("new_mobile_number", _L), ("change_date", _TS), ("ACTIVE", _S))

# Money columns: double or decimal, as the source has them.
MONEY = ("Overdue_Principal", "Overdue_Interest", "Overdue_Penalty", "outstandingBalance",
         "Total_Outstanding_Principal", "Total_Outstanding_Interest", "Total_Outstanding_Penalty")

SCHEMAS = {
    "loan_master": LOAN_MASTER,
    "installments": INSTALLMENTS,
    "calls": CALLS,
    "bucket_flow": BUCKET_FLOW,
    "contacts": CONTACTS,
}

# Report columns in output order.
REPORT = _struct(
    ("customerId", _L), ("loanAccountNumber", _S), ("disbursementDateTime", _TS),
    ("clientName", _S), ("province", _S), ("dpd", _I),
    ("Overdue_Principal", _D), ("Overdue_Interest", _D), ("Overdue_Penalty", _D),
    ("total_overdue_amount", _D), ("outstandingBalance", _D), ("total_outstanding_amount", _D),
    ("loanPaidStatus", _S), ("primary_number", _S), ("Segment", _S), ("Product", _S),
    ("lastPaidDT", _TS), ("lastrpcdate", _DT), ("lastptpdate", _DT),
    ("minunpaidinstallmentnumber", _I),
)
REPORT_COLUMNS = tuple(f.name for f in REPORT.fields)
REPORT_V0_COLUMNS = tuple(c for c in REPORT_COLUMNS if c != "loanPaidStatus")
