"""Writers of the case report: table, CSV export, Parquet, dated snapshots.

All writes run on the executors (no row passes through the driver) and are
idempotent, so a retried task or a re-run of the same run date leaves the
same files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arrearly.functions import columns as C
from arrearly.params import Params
from arrearly.session import SHUFFLE_CLEANUP, session_conf

RAW_SHEET = "Rawdata"
CSV_RECORDS = 1_000_000  # rows of a CSV file; some 250 MB of the report
SNAPSHOT_CODEC = "zstd"  # a quarter smaller than snappy on the report
# A task sorts its rows by date once it has as many writers; one that holds a single date writes them as they come.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop-if-exists + create-table-as-select in one overwrite. With ``path`` the
    table's files lie there (an external table, whose files a drop leaves);
    without, in the catalog's warehouse, which on a cluster must be shared."""
    w = df.write.mode("overwrite")
    (w.option("path", path) if path else w).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _csv_options(header: bool, sep: str, null_value: str) -> dict:
    """Options of both directions: quotes are doubled, blanks are kept."""
    return {"header": header, "sep": sep, "nullValue": null_value, "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", null_value: str = "",
               max_records: int = CSV_RECORDS) -> None:
    """Sharded CSV export, overwriting ``path``: files of at most ``max_records``
    rows, however large a partition is. A file with line ends inside values cannot be split
    by a reader, so this bounds what one task reads back.

    Quotes inside a value are doubled, blanks at its ends stay, and a value
    with a separator, quote or line end is quoted, as other tools read it.
    By default a NULL is written as an empty field, like the spreadsheet-style
    export; empty strings are quoted (``""``). Spark's reader maps both back
    to NULL unless a distinct ``null_value`` marker (e.g. ``\\N``) is used on
    both sides, which makes the round trip lossless.
    """
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).options(**_csv_options(header, sep, null_value)).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True, sep: str = ",",
             null_value: str = "") -> DataFrame:
    """Read an export back with its fixed schema (no inference). Values may
    hold line ends, so a file is read by one task; ``export_csv`` bounds its rows."""
    options = _csv_options(header, sep, null_value) | {"multiLine": True, "lineSep": "\n"}
    return spark.read.schema(schema).options(**options).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def for_file(df: DataFrame, key: str = "loanAccountNumber") -> DataFrame:
    """File-sink form of the report: a missing account number is written as
    the text 'None' (the key is already text)."""
    return df.withColumn(key, C.key_text_file(key))


def write_raw_dataset(df: DataFrame, root: str) -> str:
    """The report in its file form under ``<root>/Rawdata`` (the sheet name of
    the spreadsheet export, kept as a dataset name)."""
    path = f"{root.rstrip('/')}/{RAW_SHEET}"
    write_parquet(for_file(df), path)
    return path


def write_snapshots(df: DataFrame, root: str, dates: Iterable[dt.date], column: str = "as_of",
                    spread: bool = False) -> dict[dt.date, int]:
    """Dated outputs of several run dates in one job: the folders ``as_of=<date>`` of
    ``dates`` are replaced, other dates stay. Returns the rows per date.

    The rows are staged next to the output and moved when the whole job has succeeded
    (dynamic partition overwrite), so a job that fails or is killed half way
    leaves the old data. A date without rows ends empty: its rows are counted by the
    write itself, and only then its folder is replaced by an empty one. Rows of
    another date are an error, before anything is replaced.

    The files of a date are balanced by size, which shuffles all rows once more. With
    ``spread`` the caller says that the rows of each date are already dealt over the tasks, as
    ``report_by_dates`` and ``staged_report`` leave them and as one date always is; they are written where
    they are, a file per task and date. Shuffle files of the rows go when they are written."""
    days = sorted(set(dates))
    spark = df.sparkSession
    seen = Observation()
    counts = [F.count_if(F.col(column) == F.lit(d)).alias(d.isoformat()) for d in days]
    known = F.coalesce(F.col(column).isin([F.lit(d) for d in days]), F.lit(False))
    checked = df.withColumn(column, F.when(known, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit("not a run date of this write: "), F.coalesce(F.col(column).cast("string"), F.lit("NULL"))))))
    # Files of a date are balanced by size: no small file per task and date, no hot date in one task.
    rows = (checked if spread else checked.hint("rebalance", F.col(column))).observe(seen, *counts)
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", SNAPSHOT_CODEC)
    with session_conf(spark, SHUFFLE_CLEANUP | UNSORTED):
        out.partitionBy(column).parquet(root)
    written = {d: seen.get.get(d.isoformat(), 0) or 0 for d in days}
    empty = spark.createDataFrame([], df.drop(column).schema)
    for d, n in written.items():
        if not n:
            write_parquet(empty, f"{root.rstrip('/')}/{column}={d.isoformat()}")
    return written


def write_snapshot(df: DataFrame, root: str, p: Params) -> None:
    """One dated output per run: the folder ``as_of=<date>`` is replaced as a
    whole once the new rows are complete, so re-running a date is idempotent (also
    with no rows at all), a failed run leaves the old rows, and other dates stay. Its files
    are those of the tasks that made the rows, which AQE sizes."""
    write_snapshots(df.withColumn("as_of", F.lit(p.as_of)), root, [p.as_of], spread=True)


def read_snapshot(spark: SparkSession, root: str, p: Params | None = None) -> DataFrame:
    """All snapshots, or one run date (pruned to its partition)."""
    df = spark.read.parquet(root)
    if p is not None:
        df = df.where(F.col("as_of") == F.lit(p.as_of))
    return df
