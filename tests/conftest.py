from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from arrearly import schemas  # noqa: E402
from arrearly.sources.tables import TABLE_NAMES, LoanTables  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="arrearly-tests-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("arrearly-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster: give the session its own shared folder
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


def frame(spark, name: str, rows: list[dict]):
    """DataFrame of one input table from partial rows (missing columns NULL)."""
    schema = schemas.SCHEMAS[name]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def tables(spark, **rows) -> LoanTables:
    unknown = set(rows) - set(TABLE_NAMES)
    assert not unknown, unknown
    return LoanTables(**{n: frame(spark, n, rows.get(n, [])) for n in TABLE_NAMES})


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def loan(acct, dpd, cust=None, **kw) -> dict:
    base = dict(customerId=cust if cust is not None else acct, loanAccountNumber=acct, currentDelinquency=dpd,
                flagDisbursement=1, firstName="F", middleName="M", lastName="L", loanType="PL",
                disbursementDateTime=ts("2023-01-01 00:00:00"), mobileNo=600 + (acct or 0))
    base.update(kw)
    return base


def call(acct, when, **kw) -> dict:
    base = dict(customerId=acct, loanAccountNumber=acct, mobileNumber=1, campaignName="PROD_Pre-Collections",
                callDatetime=ts(when), connected=1, PTP_Kept=0)
    base.update(kw)
    return base


@pytest.fixture(scope="session")
def sf0001():
    return SF0001
