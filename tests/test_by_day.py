"""Call log and bucket flow stored by day: the same rows, fewer folders read."""

from __future__ import annotations

import re

from conftest import call, d, frame
from pyspark.sql import functions as F

from arrearly.operators import calls as CL
from arrearly.params import Params
from arrearly.session import scratch_path
from arrearly.sources import by_day as BD
from arrearly.sources.tables import LoanTables

P = Params.of("2024-02-10")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _partition_filters(df) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*?)\]", df._jdf.queryExecution().executedPlan().toString())


def test_all_rows_come_back(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    root = scratch_path(spark, "t-by-day")
    BD.write_tables(t, root)
    for name in BD.DAY_COLUMNS:
        back = BD.read_days(spark, root, name)
        assert back.columns == getattr(t, name).columns and _same(back, getattr(t, name))
    assert _same(spark.read.parquet(f"{root}/contacts"), t.contacts)
    # the whole report over the stored tables: rules without a date limit read all days
    stored = LoanTables(**{n: BD.read_days(spark, root, n) if n in BD.DAY_COLUMNS else spark.read.parquet(f"{root}/{n}") for n in t.as_dict()})
    from arrearly.plans import fused

    assert _same(fused.delinquency_report_fused(stored, P), fused.delinquency_report_fused(t, P))


def test_windows_prune_folders(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    root = scratch_path(spark, "t-by-day-prune")
    BD.write_by_day(t.calls, root, "calls")
    BD.write_by_day(t.bucket_flow, root, "bucket_flow")
    pruned = BD.read_trailing(spark, root, "calls", P.as_of, P.unconnected_days)
    rule = CL.unconnected_recent(pruned, P)
    assert _same(rule, CL.unconnected_recent(t.calls, P))
    for days, name, col in ((30, "calls", "call_day"), (60, "calls", "call_day"), (60, "bucket_flow", "bucket_day")):
        filters = _partition_filters(BD.read_trailing(spark, root, name, P.as_of, days))
        assert filters and all(f"{col}" in f and ">=" in f and "<=" in f for f in filters), filters
    assert any("call_day" in f for f in _partition_filters(rule))
    # a refusal counts at any date: no filter on the folders
    everything = CL.refusals(BD.read_days(spark, root, "calls"), P)
    assert not any("call_day" in f for f in _partition_filters(everything)) and _same(everything, CL.refusals(t.calls, P))
    # the window reads the window's folders only
    files = {r[0].split("call_day=")[1][:10] for r in pruned.select(F.input_file_name()).distinct().collect()}
    assert files and min(files) >= "2024-01-11" and max(files) <= "2024-02-10"


def test_dynamic_pruning_by_a_set_of_days(spark, sf0001):
    t = LoanTables.from_fixtures(spark, sf0001)
    root = scratch_path(spark, "t-by-day-dynamic")
    BD.write_by_day(t.calls, root, "calls")
    BD.write_by_day(t.bucket_flow, root, "bucket_flow")
    days = BD.read_days(spark, root, "calls").where("loanAccountNumber = 7").selectExpr("CAST(callDatetime AS DATE) AS x")
    got = BD.read_on_days(spark, root, "bucket_flow", days)
    want = t.bucket_flow.join(days.distinct(), t.bucket_flow.bucketDate == days.x, "left_semi")
    assert _same(got, want)
    few = spark.createDataFrame([(d("2024-01-15"), 1), (d("2024-01-16"), 2), (None, 1)], "x date, k int")
    few.write.parquet(f"{root}/few")
    one = BD.read_on_days(spark, root, "bucket_flow", spark.read.parquet(f"{root}/few").where("k = 1"))
    assert "dynamicpruning" in one._jdf.queryExecution().executedPlan().toString().lower()
    assert _same(one, t.bucket_flow.where("bucketDate = DATE'2024-01-15'"))


def test_rows_without_a_day_and_days_added_later(spark):
    root = scratch_path(spark, "t-by-day-null")
    first = [call(1, "2024-01-01 23:59:59"), call(2, "2024-01-02 00:00:00"), {**call(3, "2024-01-02 00:00:00"), "callDatetime": None}]
    BD.write_by_day(frame(spark, "calls", first), root, "calls")
    BD.write_by_day(frame(spark, "calls", [call(4, "2024-01-03 10:00:00"), call(5, "2024-01-02 10:00:00")]), root, "calls")  # replaces the 2nd, adds the 3rd
    ids = lambda df: sorted(r.loanAccountNumber for r in df.collect())
    assert ids(BD.read_days(spark, root, "calls")) == [1, 3, 4, 5]
    assert ids(BD.read_days(spark, root, "calls", d("2024-01-01"), d("2024-01-02"))) == [1, 5]
    assert ids(BD.read_days(spark, root, "calls", lo=d("2024-01-02"))) == [4, 5] and ids(BD.read_days(spark, root, "calls", hi=d("2024-01-01"))) == [1]
