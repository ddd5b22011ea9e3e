"""IN / NOT IN / CASE-IN semantics of the membership joins, against Spark SQL."""

from __future__ import annotations

import pytest

from arrearly.operators.nullsafe import mark, not_in, semi, semi_any


def _keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


def _set(df, col="k"):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is None, v))


CASES = [
    ([1, 2, None], []),          # empty set: every row kept, NULL key too
    ([1, 2, None], [2]),         # NULL left key dropped once the set is non-empty
    ([1, 2, None], [2, None]),   # NULL in the set: nothing survives
    ([1, 2, 3], [None]),
    ([None], [5]),
]


@pytest.mark.parametrize("left,right", CASES)
def test_not_in_matches_sql(spark, left, right):
    lf, rf = _keys(spark, left), _keys(spark, right)
    lf.createOrReplaceTempView("l")
    rf.createOrReplaceTempView("r")
    expected = _set(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r)"))
    assert _set(not_in(lf, rf, key="k")) == expected


def test_not_in_guarded_skips_null_test(spark):
    lf, rf = _keys(spark, [1, 2, None]), _keys(spark, [2])
    assert _set(not_in(lf, rf, key="k", keys_not_null=True)) == [1]
    assert _set(not_in(lf, _keys(spark, []), key="k", keys_not_null=True)) == [1, 2, None]


@pytest.mark.parametrize("left,right", CASES)
def test_semi_matches_sql(spark, left, right):
    lf, rf = _keys(spark, left), _keys(spark, right)
    lf.createOrReplaceTempView("l")
    rf.createOrReplaceTempView("r")
    expected = _set(spark.sql("SELECT k FROM l WHERE k IN (SELECT k FROM r)"))
    assert _set(semi(lf, rf, key="k")) == expected


def test_semi_any_is_or_of_in(spark):
    lf = _keys(spark, [1, 2, 3, 4, None])
    got = _set(semi_any(lf, [_keys(spark, [1, None]), _keys(spark, [3, 3])], key="k"))
    assert got == [1, 3]


def test_mark_first_match_wins(spark):
    lf = _keys(spark, [1, 2, 3, 4, None])
    out = mark(lf, [(_keys(spark, [2, 3]), "A"), (_keys(spark, [1, 2, None]), "B"), (_keys(spark, [3, 4]), "C")],
               "label", "NA", key="k")
    got = {r["k"]: r["label"] for r in out.collect()}
    assert got == {1: "B", 2: "A", 3: "A", 4: "C", None: "NA"}
