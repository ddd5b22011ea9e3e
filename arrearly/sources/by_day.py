"""Call log and bucket flow stored by day.

``<root>/<table>/<day column>=<date>``: a rule with a window of days reads the
folders of its days only (static pruning), a join with a small set of days those
that occur in it (dynamic pruning). Rules without a date limit read all. Rows without a
day lie in a folder of their own, which no window reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.sources.tables import TABLE_NAMES, LoanTables, conform

# Table -> (its time column, the folder column).
DAY_COLUMNS = {"calls": ("callDatetime", "call_day"), "bucket_flow": ("bucketDate", "bucket_day")}


def write_by_day(df: DataFrame, root: str, name: str) -> None:
    """Write a table by day; the files of a day are balanced by size. Only the
    days present are replaced, so new days can be added by the same call."""
    time, day = DAY_COLUMNS[name]
    rows = df.withColumn(day, C.day(time)).hint("rebalance", F.col(day))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(f"{root.rstrip('/')}/{name}")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    day = DAY_COLUMNS[name][1]
    return df.withColumn(day, F.col(day).cast("date")) if df.schema[day].dataType.simpleString() != "date" else df


def read_days(spark: SparkSession, root: str, name: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """The table's rows of the days [lo, hi] (None: no limit on that side)."""
    df, day = _stored(spark, root, name), F.col(DAY_COLUMNS[name][1])
    if lo is not None:
        df = df.where(day >= F.lit(lo))
    if hi is not None:
        df = df.where(day <= F.lit(hi))
    return conform(df, name)


def read_trailing(spark: SparkSession, root: str, name: str, as_of: dt.date, days: int) -> DataFrame:
    """The rows of a rule's trailing window, [as_of - days, as_of]."""
    return read_days(spark, root, name, as_of - dt.timedelta(days=days), as_of)


def read_on_days(spark: SparkSession, root: str, name: str, days: DataFrame) -> DataFrame:
    """The table's rows of the days in ``days`` (one date column): a semi join on the
    folder column, whose folders Spark prunes at run time."""
    day = DAY_COLUMNS[name][1]
    wanted = days.select(F.col(days.columns[0]).cast("date").alias(day)).where(F.col(day).isNotNull()).distinct()
    return conform(_stored(spark, root, name).join(wanted, day, "left_semi"), name)


def write_tables(t: LoanTables, root: str) -> None:
    """All five tables; call log and bucket flow by day."""
    for n in TABLE_NAMES:
        if n in DAY_COLUMNS:
            write_by_day(getattr(t, n), root, n)
        else:
            getattr(t, n).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{n}")
