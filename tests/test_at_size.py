"""What large inputs shuffle: observed days, day counts, cycle masks, snapshots written in place."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
import time
from collections import Counter

import pytest
from conftest import call, d, frame
from pyspark.sql import functions as F
from test_by_dates import adversarial
from test_plans import SCALE, _nodes, _plan

from arrearly.operators import cycles as CY
from arrearly.operators import daybits as DB
from arrearly.params import Params
from arrearly.plans import by_dates as BD
from arrearly.plans import fused, registry
from arrearly.session import scratch_path, shared_dir
from arrearly.sources import fixtures, sinks

P = Params.of("2024-02-10")
DAY = dt.timedelta(days=1)


@pytest.fixture()
def at_scale(spark):
    old = {k: spark.conf.get(k, None) for k in SCALE}
    for k, v in SCALE.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_candidate_days_are_not_shuffled(spark, at_scale):
    loans = spark.createDataFrame([(1, 13), (1, 13), (2, 200), (3, None), (None, 12)], "loanAccountNumber long, currentDelinquency int")
    seen = [d("2024-01-28"), d("2024-01-30"), d("2024-01-30"), d("2024-01-31")]
    events = spark.createDataFrame([(dt.datetime.combine(x, dt.time(9)),) for x in seen], "ts timestamp_ntz")
    flow = fixtures.bucket_flow(loans, events)
    plan = _plan(flow)
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(bucketDate") == 1, plan  # the distinct days themselves
    want = [(a, x, n - (fixtures.FIXTURE_DAY - x).days) for a, n in ((1, 13), (1, 13), (2, 200), (None, 12)) for x in sorted(set(seen))]
    assert Counter(map(tuple, flow.collect())) == Counter(r for r in want if r[2] > 0)


def test_attempts_are_counted_by_spans_of_days(spark):
    rng = random.Random(4)
    near = [d("2023-12-20") + i * DAY for i in range(50)] + [d("1969-12-31"), d("1970-01-01")]
    flow = [dict(loanAccountNumber=rng.choice([1, 2, 3, None]), bucketDate=rng.choice([*near, None]), Max_current_DPD=rng.choice([0, 1, 20, 21, 61, 90, 91, None])) for _ in range(500)]
    made = [call(rng.choice([1, 2, 4, None]), f"{rng.choice(near)} 23:59:59", campaignName=rng.choice(["SIP_Prod_Reminder", "WCL MARCH 3"]), mobileNumber=rng.choice([1, None])) for _ in range(500)]
    made.append(dict(made[0], callDatetime=None))
    calls, bucket = frame(spark, "calls", made), frame(spark, "bucket_flow", flow)
    spans = fused.bucket_spans(bucket, P).groupBy("loanAccountNumber").count().collect()
    assert spans and max(r["count"] for r in spans) <= 7  # 52 days and the unknown one
    early = Counter((r["loanAccountNumber"], r["bucketDate"]) for r in flow if r["Max_current_DPD"] in (1, 20) and r["bucketDate"])
    queue = [c for c in made if c["mobileNumber"] and c["campaignName"] == "SIP_Prod_Reminder" and c["callDatetime"]]
    want = Counter()
    for c in queue:
        want[c["loanAccountNumber"]] += early[c["loanAccountNumber"], c["callDatetime"].date()]
    got = {r.loanAccountNumber: r.attempts for r in fused.activity_features(calls, bucket, P).collect()}
    assert set(got) >= {1, 2, 3} and all(n == want[a] for a, n in got.items()) and got[1] > 0


def test_bits_and_their_places(spark):
    rng = random.Random(2)
    sets = [[], [0], [63], [0, 63], list(range(64)), list(range(1, 64)), list(range(63))] + [sorted(rng.sample(range(64), rng.randrange(1, 64))) for _ in range(30)]
    masks = [sum(1 << i for i in x) for x in sets]
    df = spark.createDataFrame([(m - (1 << 64) if m >= 1 << 63 else m,) for m in masks], "m long")
    rows = df.select(DB.lowest(F.col("m")), DB.highest(F.col("m")), DB.places(F.col("m"))).collect()
    assert [tuple(r) for r in rows] == [(min(x, default=None), max(x, default=None), x) for x in sets]


def test_attempts_in_cycles_collect_nothing(spark, at_scale):
    rows = [(1, d("2024-01-01") + i * DAY, i + 1) for i in range(30)]
    flow = frame(spark, "bucket_flow", [dict(loanAccountNumber=a, bucketDate=x, Max_current_DPD=n) for a, x, n in rows])
    calls = frame(spark, "calls", [call(1, "2024-01-05 10:00:00", PTP_Date=d("2024-01-06")), call(1, "2024-01-25 10:00:00")])
    for df in (CY.cycle_attempts(calls, flow, P), CY.promise_cycles(calls, flow, P)):
        assert not any(x.startswith("ObjectHashAggregate") for x in _nodes(df))
    assert [tuple(r) for r in CY.cycle_attempts(calls, flow, P).collect()] == [(1, d("2024-01-01"), d("2024-01-20"), 1)]


def test_a_snapshot_is_written_where_its_rows_are(spark):
    rows, day = spark.range(0, 1000, 1, 4).withColumn("v", F.lit("x")), dt.date(2024, 1, 1)
    root = scratch_path(spark, "t-in-place")
    sinks.write_snapshot(rows, root, Params.of(day))
    assert len(glob.glob(f"{root.removeprefix('file:')}/as_of=2024-01-01/part-*")) == 4  # as many as tasks: not shuffled
    two = rows.withColumn("as_of", F.explode(F.array(F.lit(day), F.lit(day + DAY))))
    for spread, files in ((True, 4), (False, 1)):
        assert sinks.write_snapshots(two, root, [day, day + DAY], spread=spread) == {day: 1000, day + DAY: 1000}
        assert len(glob.glob(f"{root.removeprefix('file:')}/as_of=2024-01-02/part-*")) == files
        assert sinks.read_snapshot(spark, root).count() == 2000


def _shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {x for x in (files.apply(i).getName() for i in range(files.size())) if x.startswith("shuffle_")}


def _new_shuffle_files(spark, old):
    """Those left a while after a write: they are removed in the background."""
    until = time.time() + 10
    while (left := _shuffle_files(spark) - old) and time.time() < until:
        time.sleep(0.1)
    return left


def test_tasks_of_many_dates_write_a_file_each(spark):
    days, root = [dt.date(2024, 1, 1) + i * DAY for i in range(5)], scratch_path(spark, "t-mixed")
    rows = spark.range(0, 400, 1, 4).withColumn("as_of", F.explode(F.array(*[F.lit(x) for x in days])))
    for part in (rows, rows.orderBy("id")):
        assert sinks.write_snapshots(part, root, days, spread=True) == {x: 400 for x in days}
        assert Counter(r.as_of for r in sinks.read_snapshot(spark, root).collect()) == {x: 400 for x in days}
    assert sinks.write_snapshots(rows, root, days, spread=True) == {x: 400 for x in days}
    assert [len(glob.glob(f"{root.removeprefix('file:')}/as_of={x}/part-*")) for x in days] == [4] * 5


def _scratch(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_a_snapshot_leaves_no_shuffle_files(spark, at_scale):
    day, old = dt.date(2024, 1, 1), _shuffle_files(spark)
    rows = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 100).alias("i")).count().withColumn("as_of", F.lit(day))
    conf = [spark.conf.get(k, None) for k in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")]
    root = scratch_path(spark, "t-no-shuffle")
    for spread in (True, False):
        assert sinks.write_snapshots(rows, root, [day], spread=spread) == {day: 100}
        assert not _new_shuffle_files(spark, old)
    assert glob.glob(f"{root.removeprefix('file:')}/as_of=2024-01-01/*.zstd.parquet")
    assert conf == [spark.conf.get(k, None) for k in ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")]


def test_staged_rows_are_those_of_the_report(spark, monkeypatch):
    t, root = adversarial(spark, 3), scratch_path(spark, "t-staged")
    for most in (24, 4):
        monkeypatch.setattr(BD, "MOST", most)
        want = BD.report_by_dates(t, P, registry.RUN_DATES)
        with BD.staged_report(t, P, [*registry.RUN_DATES, "2024-02-10"], root) as rows:  # named twice
            assert rows.schema.simpleString() == want.schema.simpleString()
            assert not any(x.startswith(("Exchange", "Sort", "Generate", "SortMergeJoin")) for x in _nodes(rows))
            assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, want.collect()))
        assert not os.path.exists(root.removeprefix("file:"))
    with pytest.raises(RuntimeError, match="stopped"):
        with BD.staged_report(t, P, registry.RUN_DATES, root) as rows:
            raise RuntimeError("stopped")
    assert not os.path.exists(root.removeprefix("file:"))
    with pytest.raises(ValueError):
        with BD.staged_report(t, P, [], root):
            pass


def test_labels_of_the_most_dates_fit_their_bits(spark):
    rng = random.Random(7)
    want = [[rng.randrange(4) for _ in range(BD.MOST)] for _ in range(20)]
    df = spark.createDataFrame([(sum(c << 2 * i for i, c in enumerate(x)),) for x in want] + [(None,)], "Segment long")
    got = df.select(*[BD._label(i).alias(f"a{i}") for i in range(BD.MOST)]).collect()
    assert [list(r) for r in got] == [[BD.LABELS[c] for c in x] for x in want] + [["NA"] * BD.MOST]


def test_many_snapshots_leave_the_snapshots_alone(spark, sf0001, at_scale):
    files, scratch = _shuffle_files(spark), _scratch(spark)
    rows = registry.QUERIES["snapshot_many_dates"](spark, sf0001)
    assert not _new_shuffle_files(spark, files)
    (left,) = _scratch(spark) - scratch
    assert left.startswith("report-many-")
    assert rows.groupBy("as_of").count().count() == len(registry.RUN_DATES)
