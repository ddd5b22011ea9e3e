"""Derive the five loan tables from the driver's TPC-H-shaped test tables.

The expressions are the fixed derivation rules written down in FIXTURES.md;
``arrearly.plans.oracle`` holds the same rules in DuckDB SQL. Everything is a
lazy DataFrame: nothing is collected, and each table grows with its inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed derivation constants (FIXTURES.md).
FIXTURE_DAY = dt.date(2024, 2, 10)
MOBILE_BASE = 639000000000
CONTACT_MOBILE_BASE = 639900000000
CALL_CAMPAIGNS_BY_MOD8 = (
    "PROD_Pre-Collections",
    "PROD_Hard Collections",
    "PROD_Soft Collections_Daily",
    "SIP_Prod_Reminder",
    "Collection HaRD PTPr",
    "Collections_Soft PTPr",
    "WCL MARCH 3",
    "Unlisted Campaign",
)
LOAN_TYPES_BY_MOD4 = ("BNPL", "TSBL", "TUL", "PL")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_if(cond, value):
    return F.when(~cond, value)


def _pick(index_col, values):
    """values[index_col] as a CASE chain (index_col is a small integer)."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index_col == i, F.lit(v)) if expr is None else expr.when(index_col == i, F.lit(v))
    return expr


def loan_master(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").join(n, F.col("c_nationkey") == n.n_nationkey, "inner")
    ok, ck, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return j.select(
        ck.alias("customerId"),
        ok.alias("loanAccountNumber"),
        F.col("o_orderdate").alias("disbursementDateTime"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("firstName"),
        _null_if(ck % 7 == 0, F.col("c_mktsegment")).alias("middleName"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("lastName"),
        F.col("n_name").alias("province"),
        _null_if(ok % 17 == 0, ok % 131).cast("int").alias("currentDelinquency"),
        _null_if(ok % 19 == 0, price * 0.125).alias("Overdue_Principal"),
        _null_if(ok % 23 == 0, price * 0.03125).alias("Overdue_Interest"),
        _null_if(ok % 5 == 0, price * 0.015625).alias("Overdue_Penalty"),
        (price * 0.5).alias("outstandingBalance"),
        (price * 0.5).alias("Total_Outstanding_Principal"),
        _null_if(ok % 23 == 0, price * 0.0625).alias("Total_Outstanding_Interest"),
        _null_if(ok % 13 == 0, price * 0.03125).alias("Total_Outstanding_Penalty"),
        _null_if(ck % 9 == 0, F.lit(MOBILE_BASE) + ck).alias("mobileNo"),
        _pick(ok % 4, LOAN_TYPES_BY_MOD4).alias("loanType"),
        _null_if(ck % 3 == 1, F.concat(F.lit("PK"), ck.cast("string"))).alias("purpleKey"),
        F.when(ck % 4 == 0, 0).when(ck % 4 == 1, 1).when(ck % 4 == 2, 2).cast("int").alias("isUserAtStore"),
        _null_if(F.col("o_orderstatus") == "O", F.col("o_orderdate")).alias("lastPaidDT"),
        F.col("o_orderstatus").alias("loanPaidStatus"),
        F.when(ok % 29 == 0, 0).otherwise(1).cast("int").alias("flagDisbursement"),
        F.when(ck % 2 == 0, 1).otherwise(0).cast("int").alias("obsFPD00"),
        F.when(ck % 3 == 0, 1).otherwise(0).cast("int").alias("obsSPD00"),
        F.when(ck % 5 == 0, 1).when(ck % 11 == 0, None).otherwise(0).cast("int").alias("obsTPD00"),
    )


def installments(lineitem: DataFrame) -> DataFrame:
    ln = F.col("l_linenumber")
    due = F.date_add(F.lit(FIXTURE_DAY), (ln * 30 - 120 + F.col("l_partkey") % 45).cast("int"))
    paid = F.when(
        (F.col("l_linestatus") == "F") & (ln <= 3), F.date_add(due, (F.col("l_suppkey") % 20).cast("int"))
    )
    return lineitem.select(
        F.col("l_orderkey").alias("loanAccountNumber"),
        ln.cast("int").alias("installmentNumber"),
        due.alias("installmentDueDate"),
        F.when(F.col("l_returnflag") == "R", "PARTIALPAYMENT")
        .when(F.col("l_returnflag") == "A", "FULLPAYMENT")
        .alias("directDebitStatus"),
        paid.alias("lastPaymentDate"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("int").alias("isCurrentDelinquent"),
    )


def _wrapup(eid, etype):
    even = eid % 2 == 0
    return (
        F.when(eid % 10 == 9, F.lit(None).cast("string"))
        .when((etype == "error") & even, "Unsuccessful - Dead Air")
        .when(etype == "error", "Wrap up - Drop Call")
        .when((etype == "view") & even, "Promise to Pay")
        .when(etype == "view", "PTP Reminder")
        .when((etype == "click") & even, "Refuse to Pay")
        .when(etype == "click", "Call Back - 3rd Party")
        .when((etype == "purchase") & even, "Payment Already Made")
        .when(etype == "purchase", "No payment yet")
        .otherwise("Customer Hang Up")
    )


def calls(events: DataFrame, orders: DataFrame) -> DataFrame:
    # (event_id + o_orderkey) % 3 == 0  <=>  o_orderkey % 3 == (3 - event_id % 3) % 3 for the
    # non-negative keys used here; as an equi-key it keeps non-matching event x order pairs of a
    # customer from ever being produced and spreads one customer over three join keys.
    e = events.select("event_id", "ts", "user_id", "event_type",
                      ((F.lit(3) - F.col("event_id") % 3) % 3).alias("_res"))
    o = orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 3).alias("_res"))
    j = e.join(o, (e.user_id == o.o_custkey) & (e._res == o._res)
               & ((e.event_id + o.o_orderkey) % 3 == 0), "inner")
    eid, ts = F.col("event_id"), F.col("ts")
    promise = eid % 30 == 0
    return j.select(
        F.col("user_id").alias("customerId"),
        _null_if(eid % 37 == 0, F.col("o_orderkey")).alias("loanAccountNumber"),
        _null_if(eid % 11 == 0, F.lit(MOBILE_BASE) + F.col("user_id")).alias("mobileNumber"),
        _pick(eid % 8, CALL_CAMPAIGNS_BY_MOD8).alias("campaignName"),
        ts.alias("callDatetime"),
        F.when(eid % 3 == 0, 0).when(eid % 3 == 1, 1).cast("int").alias("connected"),
        F.when(promise, F.date_add(ts.cast("date"), (eid % 60 + 3).cast("int"))).alias("PTP_Date"),
        F.when(promise, 1).otherwise(0).cast("int").alias("PTP_Kept"),
        F.when(promise, F.date_add(ts.cast("date"), (eid % 120 - 60).cast("int"))).alias("Payment_Receiving_Date"),
        _wrapup(eid, F.col("event_type")).alias("genesysWrapupDisposition"),
        F.when(eid % 13 == 0, F.lit("Client REFUSED")).alias("subdisposition"),
    )


def bucket_flow(loans: DataFrame, events: DataFrame) -> DataFrame:
    """One row per loan and observed day d with DPD(d) = dpd - (FIXTURE_DAY - d) > 0.

    d > FIXTURE_DAY - dpd, so instead of pairing every loan with every day the
    candidate days of each loan are generated (bounded by the observed day
    span) and equi-joined with the set of observed days. That set has one row per
    calendar day however many events there are, so it is broadcast: the candidate
    rows, some tens per loan, are not shuffled by their day, of which there are few.
    """
    days = events.select(F.col("ts").cast("date").alias("bucketDate")).distinct()
    span = events.select(
        F.struct(F.min(F.col("ts").cast("date")).alias("lo"), F.max(F.col("ts").cast("date")).alias("hi"))
    ).scalar()
    dpd = F.col("currentDelinquency")
    first = F.greatest(F.date_add(F.lit(FIXTURE_DAY), (F.lit(1) - dpd)), span.getField("lo"))
    last = span.getField("hi")
    cand = loans.select("loanAccountNumber", "currentDelinquency").where(dpd.isNotNull()).select(
        "loanAccountNumber",
        "currentDelinquency",
        F.explode(F.when(first <= last, F.sequence(first, last))).alias("bucketDate"),
    )
    j = cand.join(F.broadcast(days), "bucketDate", "inner")
    return j.select(
        "loanAccountNumber",
        "bucketDate",
        (dpd - F.datediff(F.lit(FIXTURE_DAY), F.col("bucketDate"))).cast("int").alias("Max_current_DPD"),
    )


def contacts(orders: DataFrame) -> DataFrame:
    o = orders.where(F.col("o_orderpriority") == "1-URGENT")
    ok = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        (F.lit(CONTACT_MOBILE_BASE) + ok).alias("new_mobile_number"),
        F.col("o_orderdate").alias("change_date"),
        F.when(ok % 6 == 0, "N").otherwise("Y").alias("ACTIVE"),
    )


def derive_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = _read(spark, sf_dir, "orders")
    events = _read(spark, sf_dir, "events")
    lm = loan_master(orders, _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "nation"))
    return {
        "loan_master": lm,
        "installments": installments(_read(spark, sf_dir, "lineitem")),
        "calls": calls(events, orders),
        "bucket_flow": bucket_flow(lm, events),
        "contacts": contacts(orders),
    }
