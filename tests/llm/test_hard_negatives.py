"""Hard negatives against plain sorting in whole numbers."""

from __future__ import annotations

import math
import random

import duckdb
import pytest

from arrearly.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, is_anchor, positives=5, negatives=5):
    """rows: (vec_id, label, vector) that take part."""
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for a, ya, va in sorted({(i, y, tuple(v)) for i, y, v in rows if is_anchor(i)}):
        own = [(-sum(p * q for p, q in zip(va, v)), i, y) for i, y, v in rows if i != a and len(v) == len(va)]
        own.sort()
        for score, i, _ in [x for x in own if x[2] == ya][:positives]:
            p = -score
            hits = [(n, -s) for s, n, y in own if y != ya and 80 * p <= 100 * -s <= 100 * p][:negatives]
            out += [(a, i, r, n, p, s) for r, (n, s) in enumerate(hits, 1)]
    return sorted(out)


def vectors(seed, n, dim=6, labels=4, spread=0.4):
    rng = random.Random(seed)
    heads = [[rng.choice([0.0, 0.5, 1.0]) for _ in range(dim)] for _ in range(labels)]
    # Coarse values, so that scores tie.
    return [(i, rng.randrange(labels), [round((h + rng.uniform(-spread, spread)) * 8) / 8 for h in heads[rng.randrange(labels)]]) for i in range(n)]


def mined(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema).repartition(5)
    return sorted(map(tuple, H.mine(df, df.where("vec_id % 10 = 0"), **kw).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_sorting(spark, docs_of, seed):
    rows = vectors(seed, 300)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 100 and mined(spark, rows) == want


def test_several_passes_over_the_rows_give_the_same(spark, docs_of):
    rows = vectors(7, 200)
    assert mined(spark, rows, anchor_bytes=400) == brute(rows, lambda i: i % 10 == 0)


def test_one_label_and_one_vector_hold_most_rows(spark, docs_of):
    rows = [(i, 0 if i % 3 else 1, [0.5, 0.5]) for i in range(400)]  # all scores tie
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part_and_repeated_rows(spark, docs_of):
    good = vectors(3, 60)
    bad = [(70, None, [1.0] * 6), (80, 1, None), (90, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (100, 1, [float("nan")] * 6),
           (110, 2, [float("inf")] + [1.0] * 5), (None, 1, [1.0] * 6)]
    assert mined(spark, good + bad) == brute(good, lambda i: i % 10 == 0)
    twice = good + [good[0], good[0], good[11], good[11]]  # an anchor and a row, each three times
    assert mined(spark, twice) == brute(twice, lambda i: i % 10 == 0)
    other = good + [(20, 3, [1.0] * 6), (201, 0, [1.0, 1.0]), (210, 0, [0.5, 0.5]), (202, 1, [0.9, 0.9])]  # an id with two vectors, shorter vectors
    assert mined(spark, other) == brute(other, lambda i: i % 10 == 0)
    assert mined(spark, [(0, 1, []), (1, 1, []), (2, 2, [])]) == [(0, 1, 1, 2, 0, 0)]


def test_windows_of_zero_and_negative_scores(spark, docs_of):
    rows = [(0, 0, [1.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 1, [0.0, -1.0]), (3, 1, [-0.5, 0.0]), (4, 0, [-0.5, 0.0]), (5, 1, [0.25, 0.0])]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0) == [(0, 1, 1, 2, 0, 0)]


def test_empty_and_lonely(spark, docs_of):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])]) == []  # no other label
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []  # no positive


def test_large_components(spark, docs_of):
    """Sums beyond 2^53 stay exact; beyond a long they are cut to a long."""
    rows = [(0, 0, [3.0e6, 1.0]), (1, 0, [3.0e6 + 1 / 256, 2.0]), (2, 1, [3.0e6, 1.5]), (3, 1, [3.0e6 - 1 / 256, 7.0])]
    schema = "vec_id long, label int, embedding array<double>"
    assert mined(spark, rows, schema) == brute(rows, lambda i: i % 10 == 0) != []
    huge = mined(spark, [(0, 0, [1e300]), (1, 0, [1e299]), (2, 1, [1e250]), (3, 1, [-1e300])], schema)
    top = 2**63 - 1
    assert huge == [(0, 1, 1, 2, top, top)]


def test_keys_sort_as_pairs_should():
    rng = random.Random(5)
    ends = [-2**62, -1, 0, 1, 2**62]
    keys = [(rng.choice(ends), rng.randrange(3), rng.choice(ends), rng.random() < 0.5, rng.choice(ends)) for _ in range(300)]
    packed = sorted(H.pack(*k) for k in keys)
    assert [H.unpack(b) for b in packed] == sorted(keys, key=lambda k: (k[0], k[1], -k[2], k[3], k[4]))


def test_wide_input(spark, docs_of):
    rows = vectors(1, 120)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS anchor", "'k' AS key", "2 AS rank", "3 AS score").repartition(3)
    assert sorted(map(tuple, H.mine(df, df.where("vec_id % 10 = 0")).collect())) == brute(rows, lambda i: i % 10 == 0)


def test_contract_against_sql_and_plain(spark, small, sf0001):
    got = sorted(map(tuple, H.contract(small("embeddings")).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf0001}/embeddings.parquet')")
    assert got == sorted(con.execute(H.SQL).fetchall()) != []
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in small("embeddings").collect()]
    assert got == brute(rows, lambda i: i % 100 == 0)
