"""Hot keys: one account holds a third of the calls and bucket rows, one
customer a third of the loans. AQE's skew handling is forced to split
partitions (tiny thresholds) and the reports must still equal the SQL oracle
run by DuckDB on the same skewed tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from arrearly import schemas
from arrearly.params import FIXTURE_AS_OF, Params
from arrearly.operators.nullsafe import left_join_spread
from arrearly.plans import fused, report
from arrearly.plans.oracle import rule_ctes
from arrearly.sources.tables import TABLE_NAMES, LoanTables

HOT_ACCOUNT = 7
HOT_CUSTOMER = 11
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # one map task could not be split
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _third(*cols):
    return F.pmod(F.xxhash64(*cols), F.lit(3)) == 0


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_keys_give_the_oracle_result(spark, sf0001, skew_conf):
    t = LoanTables.from_fixtures(spark, sf0001)
    acct = F.col("loanAccountNumber")
    hot = {
        "loan_master": t.loan_master.withColumn(
            "customerId", F.when(_third("loanAccountNumber"), F.lit(HOT_CUSTOMER).cast("bigint"))
            .otherwise(F.col("customerId"))),
        "installments": t.installments,
        "calls": t.calls.withColumn(
            "loanAccountNumber", F.when(_third("callDatetime", "customerId"), F.lit(HOT_ACCOUNT).cast("bigint"))
            .otherwise(acct)),
        "bucket_flow": t.bucket_flow.withColumn(
            "loanAccountNumber", F.when(_third("loanAccountNumber", "bucketDate"), F.lit(HOT_ACCOUNT).cast("bigint"))
            .otherwise(acct)),
        "contacts": t.contacts,
    }
    # materialise the skewed tables once, so Spark and DuckDB read the same rows
    data = {n: hot[n].select(*[f.name for f in schemas.SCHEMAS[n].fields]).toArrow() for n in TABLE_NAMES}
    st = LoanTables(**{
        n: spark.createDataFrame([tuple(r.values()) for r in data[n].to_pylist()], schemas.SCHEMAS[n])
        for n in TABLE_NAMES
    })
    assert data["calls"].num_rows > 0
    hot_calls = sum(1 for v in data["calls"].column("loanAccountNumber").to_pylist() if v == HOT_ACCOUNT)
    assert hot_calls * 4 > data["calls"].num_rows  # roughly a third of all calls

    p = Params.of(FIXTURE_AS_OF)
    cols = list(schemas.REPORT_COLUMNS)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in TABLE_NAMES:
        con.register(n, data[n])
    want = sorted(con.execute(f"WITH {rule_ctes(p)}\nSELECT {', '.join(cols)} FROM report").fetchall(), key=repr)
    con.close()
    for build in (fused.delinquency_report_fused, report.delinquency_report):
        df = build(st, p).select(cols)
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        assert got == want, build.__name__
        ran = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in ran and "skew=true" in ran and "skewed" in ran, build.__name__  # a partition was split


def test_rows_without_a_key_are_not_in_one_task(spark, skew_conf):
    """NULL accounts and NULL customers, two thirds of the loans, go round the
    account join and are spread over the contact join."""
    from conftest import loan, tables

    rows = [loan(i if i % 3 else None, 5, cust=i if i % 3 == 1 else 0) for i in range(300)]
    for r in rows:
        r["customerId"] = r["customerId"] or None
    t = tables(spark, loan_master=rows, contacts=[dict(customer_id=1, new_mobile_number=9, ACTIVE="Y"), dict(customer_id=None, new_mobile_number=8, ACTIVE="Y")])
    rep = fused.delinquency_report_fused(t, Params.of(FIXTURE_AS_OF)).collect()
    assert len(rep) == 300 and all(r.Segment == "NA" for r in rep)
    left = t.loan_master.select("customerId", "loanAccountNumber", "currentDelinquency")
    right = t.contacts.select(F.col("customer_id").alias("customerId"), "new_mobile_number")
    joined = left_join_spread(left, right, "customerId", "currentDelinquency", ways=4)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customerId" in plan and "_way" in plan.split("hashpartitioning(", 1)[1].split(")")[0], plan
    assert joined.columns == ["customerId", "loanAccountNumber", "currentDelinquency", "new_mobile_number"] and joined.count() == 300
