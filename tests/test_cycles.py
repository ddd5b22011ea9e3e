"""Delinquency cycles, attempt days and promises in them, against plain loops."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import call, d, frame

from arrearly.operators import cycles as CY
from arrearly.operators import daybits as DB
from arrearly.params import Params
from test_plans import SCALE, _count, _nodes

P = Params.of("2024-02-10")
DAY = dt.timedelta(days=1)


def bucket(spark, rows):
    return frame(spark, "bucket_flow", [dict(loanAccountNumber=a, bucketDate=x, Max_current_DPD=n) for a, x, n in rows])


def brute_cycles(rows, p=P):
    """account -> [(start, end, highest, early end, open)] in order."""
    days = {}
    for a, x, n in rows:
        if a is not None and x is not None and x <= p.as_of and (n or 0) > 0:
            days.setdefault(a, {})
            days[a][x] = max(n, days[a].get(x, 0))
    out = {}
    for a, own in days.items():
        runs = []
        for x in sorted(own):
            if runs and runs[-1][-1] == x - DAY:
                runs[-1].append(x)
            else:
                runs.append([x])
        out[a] = [(r[0], r[-1], max(own[x] for x in r), max((x for x in r if p.early_dpd[0] <= own[x] <= p.early_dpd[1]), default=None),
                   r[-1] == p.as_of) for r in runs]
    return out


def got_cycles(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.cycle_start):
        out.setdefault(r.loanAccountNumber, []).append((r.cycle_start, r.cycle_end, r.highest_dpd, r.early_end, r.is_open))
    return out


def test_edges(spark):
    rows = [
        (1, d("2024-02-08"), 5), (1, d("2024-02-09"), 6), (1, d("2024-02-10"), 7),  # open
        (2, d("2024-01-01"), 3), (2, d("2024-01-03"), 1), (2, d("2024-01-04"), 2),  # a missing day ends a cycle
        (3, d("2024-01-01"), 4), (3, d("2024-01-01"), 25), (3, d("2024-01-02"), None), (3, d("2024-01-02"), 5), (3, d("2024-01-03"), 0),  # two rows a day, null
        (4, d("2024-01-01"), None), (4, d("2024-01-02"), 0),  # never delinquent
        (5, d("2024-02-11"), 9),  # after the run date
        (None, d("2024-01-01"), 9), (6, None, 9),
        (7, d("2024-01-05"), 30), (7, d("2024-01-06"), 31),  # no early day
        *[(8, d("2023-06-01") + i * DAY, i + 1) for i in range(200)],  # over several chunks
        (9, d("1969-12-31"), 1), (9, d("1970-01-01"), 2), (9, d("1970-01-02"), 3),  # day numbers around 0
    ]
    got = got_cycles(CY.cycles(bucket(spark, rows).repartition(4), P))
    assert got == brute_cycles(rows)
    assert got[1] == [(d("2024-02-08"), d("2024-02-10"), 7, d("2024-02-10"), True)]
    assert got[3] == [(d("2024-01-01"), d("2024-01-02"), 25, d("2024-01-02"), False)]
    assert got[7][0][3] is None and got[8] == [(d("2023-06-01"), d("2023-06-01") + 199 * DAY, 200, d("2023-06-20"), False)]
    assert got[9] == [(d("1969-12-31"), d("1970-01-02"), 3, d("1970-01-02"), False)] and not {4, 5, 6, None} & set(got)
    assert CY.cycles(bucket(spark, []), P).count() == 0


def random_flow(seed):
    rng = random.Random(seed)
    rows = []
    for a in range(12):
        x = d("2023-09-01")
        while x < d("2024-02-15"):
            x += rng.choice([1, 1, 1, 1, 2, 40]) * DAY
            rows += [(a, x, rng.choice([0, 1, 2, 20, 21, 90, None]))] * rng.choice([1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_flows(spark, seed):
    rows = random_flow(seed)
    assert got_cycles(CY.cycles(bucket(spark, rows).repartition(5), P)) == brute_cycles(rows)
    current = {r.loanAccountNumber: r.cycle_start for r in CY.current_cycles(bucket(spark, rows), P).collect()}
    assert current == {a: c[-1][0] for a, c in brute_cycles(rows).items()}


@pytest.mark.parametrize("seed", range(2))
def test_attempt_days_and_promises(spark, seed):
    rows = random_flow(seed + 10)
    rng = random.Random(seed)
    made = []
    for _ in range(900):
        when = d("2023-09-01") + rng.randrange(180) * DAY
        made.append(call(rng.choice([*range(14), None]), f"{when} {rng.randrange(24):02d}:30:00", campaignName=rng.choice(["SIP_Prod_Reminder", "Unlisted"]),
                         mobileNumber=rng.choice([1, 1, 1, None]), PTP_Date=rng.choice([None, when + rng.randrange(30) * DAY])))
    calls, flow = frame(spark, "calls", made), bucket(spark, rows)
    known = [c for c in made if c["loanAccountNumber"] is not None and c["mobileNumber"] and c["campaignName"] == "SIP_Prod_Reminder"]
    cycles = brute_cycles(rows)
    want = {}
    for a, own in cycles.items():
        start, _, _, early, _ = own[-1]
        days = {c["callDatetime"].date() for c in known if c["loanAccountNumber"] == a}
        n = sum(1 for x in days if early and start <= x <= early)
        if n:
            want[a] = n
    assert {r.loanAccountNumber: r.attempt_days for r in CY.cycle_attempts(calls, flow, P).collect()} == want != {}
    asked = {(c["loanAccountNumber"], c["PTP_Date"]) for c in known if c["PTP_Date"] and c["PTP_Date"] <= P.as_of}
    want = set()
    for a, x in asked:
        before = [c for c in cycles.get(a, []) if c[0] <= x]
        want.add((a, x, before[-1][0] if before else None, bool(before) and x <= before[-1][1], a in cycles and x >= cycles[a][-1][0]))
    assert {tuple(r) for r in CY.promise_cycles(calls, flow, P).collect()} == want
    assert CY.promise_cycles(calls, flow, P).count() == len(want)


def test_promise_ties(spark):
    flow = bucket(spark, [(1, d("2024-01-10"), 1), (1, d("2024-01-20"), 1), (1, d("2024-01-21"), 2)])
    calls = frame(spark, "calls", [call(1, "2024-01-01 10:00:00", PTP_Date=x) for x in
                                   (d("2024-01-09"), d("2024-01-10"), d("2024-01-11"), d("2024-01-20"), d("2024-01-20"), d("2024-02-10"), d("2024-02-11"))])
    got = sorted((r.promise_day, r.cycle_start, r.in_cycle, r.in_current) for r in CY.promise_cycles(calls, flow, P).where("cycle_start is not null").collect())
    assert got == [(d("2024-01-10"), d("2024-01-10"), True, False), (d("2024-01-11"), d("2024-01-10"), False, False),
                   (d("2024-01-20"), d("2024-01-20"), True, True), (d("2024-02-10"), d("2024-01-20"), False, True)]
    assert [r.loanAccountNumber for r in CY.promised_in_current(calls, flow, P).collect()] == [1]


def test_more_than_ten_days_not_calls(spark):
    start = d("2024-01-01")
    flow = bucket(spark, [(a, start + i * DAY, i + 1) for a in (1, 2) for i in range(30)])
    many = [call(1, f"2024-01-02 {h:02d}:00:00") for h in range(24)]  # one day
    days = [call(2, f"{start + i * DAY} 09:00:00") for i in range(11)] + [call(2, "2024-01-25 09:00:00")]  # eleven early days, one late
    got = {r.loanAccountNumber: r.attempt_days for r in CY.cycle_attempts(frame(spark, "calls", many + days), flow, P).collect()}
    assert got == {1: 1, 2: 11}
    assert [r.loanAccountNumber for r in CY.attempts_over(frame(spark, "calls", many + days), flow, P).collect()] == [2]


def test_day_sets(spark):
    rng = random.Random(1)
    days = sorted({d("1969-10-01") + rng.randrange(300) * DAY for _ in range(120)})
    df = spark.createDataFrame([(1, x) for x in days * 2] + [(1, None)], "k int, x date")
    from pyspark.sql import functions as F

    sets = DB.day_sets(df, "k", F.col("x"))
    for lo, hi in [(days[3], days[40]), (days[0], days[-1]), (days[5], days[5]), (days[9], days[2]), (None, days[3]), (d("1900-01-01"), d("2100-01-01"))]:
        n = sets.agg(F.sum(DB.days_between(F.col("days"), F.col("chunk"), F.lit(lo).cast("date"), F.lit(hi).cast("date")))).first()[0]
        assert n == (sum(1 for x in days if lo <= x <= hi) if lo else 0)


def test_hot_account_and_plan(spark):
    from pyspark.sql import functions as F

    # One account holds most rows: 60,000 over 300 days, many a day.
    hot = spark.range(60_000).select((F.col("id") % 1 + 1).alias("loanAccountNumber"), F.date_add(F.lit(d("2023-04-01")), (F.col("id") % 300).cast("int")).alias("bucketDate"),
                                     (F.col("id") % 7 + 1).cast("int").alias("Max_current_DPD"))
    got = CY.cycles(hot, P).collect()
    assert [(r.cycle_start, r.cycle_end, r.highest_dpd) for r in got] == [(d("2023-04-01"), d("2023-04-01") + 299 * DAY, 7)]
    old = {k: spark.conf.get(k, None) for k in SCALE}
    for k, v in SCALE.items():
        spark.conf.set(k, v)
    try:
        df = CY.cycles(hot, P)
        # The rows are shuffled once, after partial aggregation; the second exchange carries runs.
        assert _count(df, "Exchange") == 2 and _count(df, "ObjectHashAggregate") >= 2
        names = [x for x in _nodes(df) if x.startswith(("Exchange", "Window", "ObjectHashAggregate"))]
        assert [x.split(" ")[0] for x in names[:3]] == ["ObjectHashAggregate", "Exchange", "ObjectHashAggregate"], names
        calls = frame(spark, "calls", [call(1, "2023-04-05 10:00:00")])
        joined = CY.cycle_attempts(calls, hot, P)
        assert not any("NestedLoop" in x or "Cartesian" in x for x in _nodes(joined))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
