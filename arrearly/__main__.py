"""Run the collections case report for one run date.

    python -m arrearly --tables <parquet root> --as-of 2024-12-26 --out <dir> [--csv] [--table name]
    python -m arrearly --fixtures /root/testdata/sf0.01 --out <dir>
    python -m arrearly --tables <parquet root> --as-of 2024-11-30,2024-12-31 --out <dir>

With several run dates, their snapshots are written together from one pass over the inputs, by way of
rows kept in a folder of the run under ``<out>``; the other outputs are of the last date. Writes the report as a dated snapshot (``<out>/snapshots/as_of=<date>``) and as
the file dataset ``<out>/Rawdata``, optionally a CSV export (``<out>/csv/<date>``) and a catalog table, and prints
the column profile (one row per column; the only thing that reaches the
driver).
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid

from arrearly.operators.profile import profile
from arrearly.params import Params
from arrearly.plans import fused, report
from arrearly.plans.by_dates import staged_report
from arrearly.session import build_session
from arrearly.sources import sinks
from arrearly.sources.tables import LoanTables


def main(argv=None, spark=None) -> None:
    ap = argparse.ArgumentParser(prog="arrearly")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="root folder with the five Parquet tables")
    src.add_argument("--fixtures", help="driver test-table folder to derive the tables from")
    ap.add_argument("--as-of", default=None,
                    help="run date (YYYY-MM-DD), or several with commas; default: the current date (UTC)")
    ap.add_argument("--out", required=True, help="output root")
    ap.add_argument("--csv", action="store_true", help="also export CSV")
    ap.add_argument("--table", default=None, help="also (re)create this catalog table")
    ap.add_argument("--stepwise", action="store_true", help="use the step-wise plan")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = spark or build_session(a.master)
    dates = sorted({dt.date.fromisoformat(x) for x in a.as_of.split(",")}) if a.as_of else [dt.datetime.now(dt.timezone.utc).date()]
    if len(dates) > 1 and a.stepwise:
        ap.error("--stepwise takes one run date")
    p = Params.of(dates[-1])
    t = LoanTables.from_parquet(spark, a.tables) if a.tables else LoanTables.from_fixtures(spark, a.fixtures)
    out = a.out.rstrip("/")
    if len(dates) > 1:
        with staged_report(t, p, dates, f"{out}/_rows-{uuid.uuid4().hex}") as rows:
            sinks.write_snapshots(rows, f"{out}/snapshots", dates, spread=True)
    else:
        df = (report.delinquency_report if a.stepwise else fused.delinquency_report_fused)(t, p)
        sinks.write_snapshot(df, f"{out}/snapshots", p)
    written = sinks.read_snapshot(spark, f"{out}/snapshots", p).drop("as_of")
    sinks.write_raw_dataset(written, out)
    if a.csv:
        sinks.export_csv(sinks.for_file(written), f"{out}/csv/{p.as_of_iso}")
    if a.table:
        sinks.write_table(written, a.table)
    columns = profile(written).orderBy("position").collect()
    for r in columns:
        print(f"{r['position']:>3} {r['column_name']:<28} {r['non_null']:>10} non-null  {r['data_type']}")
    print(f"rows: {columns[0]['rows'] if columns else 0}")


if __name__ == "__main__":
    main()
