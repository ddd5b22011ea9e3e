from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from arrearly.llm import quality as Q
from arrearly.llm.common import crc_mod


def test_held_out_accuracy(spark, small):
    docs, labels = small("documents"), small("labels")
    # train on the rows that the contract holds out, test on the others: a harder cut of a small table
    held = crc_mod(F.col("doc_id"), 3) == 1
    got = Q.contract(docs, labels)
    assert got.count() == docs.count() and got.where("held_out").count() == docs.where(held).count()
    known = got.join(labels, "doc_id").where("held_out")
    right = known.where("predicted = quality").count() / known.count()
    assert right >= 0.95, right
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_features_and_ftrl():
    f, d, count = Q.features(["Go go GO", None, "", "a | b", "%% x"])
    same, caps = (int(x >> np.uint64(64 - Q.BITS)) for x in (Q._SAME, Q._CAPS))
    first = f[d == 0].tolist()
    assert first.count(same) == 2 and first.count(caps) == 1 and count.tolist() == [6, 0, 0, 5, 3]
    w = Q.train(["good text here"] * 20 + ["bad !! bad !!"] * 20, [1] * 20 + [0] * 20)
    score = lambda t: Q.sigmoid(sum(w[i] for i in Q.features([t])[0]) * Q.SCALE / max(Q.features([t])[2][0], 1) + w[-1])
    assert score("good text") > 0.6 > 0.4 > score("bad !!")


def plain_features(text):
    """Feature numbers of a text, token by token."""
    import re

    kinds = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", text.encode())
    one = lambda b: Q.span_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0]
    h = [one(k.lower()) for k in kinds]
    word = [Q._SAME if i and h[i] == h[i - 1] else x for i, x in enumerate(h)]
    with np.errstate(over="ignore"):
        pairs = [Q.mix(np.array([a * Q.M3 + b]))[0] for a, b in zip(word, word[1:])]
    caps = [Q._CAPS for k in kinds if sum(65 <= c <= 90 for c in k) >= 2 and not any(97 <= c <= 122 for c in k)]
    return sorted(int(x >> np.uint64(64 - Q.BITS)) for x in [*word, *pairs, *caps])


def plain_train(texts, labels):
    """FTRL-proximal one coordinate at a time."""
    bias = 1 << Q.BITS
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= Q.L1:
            return 0.0
        return -(zi - (Q.L1 if zi > 0 else -Q.L1)) / ((Q.BETA + n.get(i, 0.0) ** 0.5) / Q.ALPHA + Q.L2)

    for _ in range(Q.EPOCHS):
        for text, y in zip(texts, labels):
            f = plain_features(text)
            x = {i: f.count(i) * Q.SCALE / max(len(f), 1) for i in set(f)} | {bias: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / Q.ALPHA * w[i]
    return {i: weight(i) for i in z}


TEXTS = ["Good words here, good words.", "BAD!! bad bad !!", "été à la plage 文字", "", "A a A\n\tb | c", "x", "MORE bad!! %% %% CAPS"]


def test_features_training_and_scores_recomputed_plainly(spark, docs_of):
    f, d, _ = Q.features(TEXTS)
    for i, text in enumerate(TEXTS):
        assert sorted(f[d == i].tolist()) == plain_features(text), text
    y = [1, 0, 1, 0, 1, 1, 0]
    w, plain = Q.train(TEXTS, y), plain_train(TEXTS, y)
    assert set(np.flatnonzero(w).tolist()) <= set(plain) and all(abs(w[i] - v) < 1e-9 for i, v in plain.items())
    got = {r.doc_id: r.score for r in Q.score(docs_of(list(enumerate(TEXTS))), w).collect()}
    for i, text in enumerate(TEXTS):
        own = plain_features(text)
        dot = sum(np.float32(plain.get(k, 0.0)) for k in own) * Q.SCALE / max(len(own), 1) + np.float32(plain[1 << Q.BITS])
        assert abs(got[i] - 1 / (1 + np.exp(-dot))) < 1e-5


def test_labels_without_a_document_change_nothing(spark, docs_of):
    docs = docs_of([(i, ("good fine words " if i % 2 else "BAD!! %% junk ") * (i % 5 + 1)) for i in range(60)])
    own = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int").selectExpr("*", "'t' AS text", "1 AS size", "2 AS y")
    foreign = spark.range(1000, 50000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality", "0 AS toxic", "'t' AS text", "1 AS size", "2 AS y")
    rows = lambda labels, **kw: sorted((r.doc_id, r.y) for r in Q.sample(docs, labels, **kw).collect())
    assert rows(own) == rows(own.unionByName(foreign)) == [(i, i % 2) for i in range(60)]
    assert len(rows(own.unionByName(foreign), rows=25)) == 25 and set(rows(own.unionByName(foreign), rows=25)) == set(rows(own, rows=25))
    assert np.array_equal(Q.fit(docs, own), Q.fit(docs, own.unionByName(foreign)))


def test_sample_is_bounded_by_bytes(spark, docs_of):
    docs = docs_of([(i, "w " * (50 * i)) for i in range(1, 30)] + [(3, "again")])
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    size = {i: 100 * i for i in range(1, 30)}
    for most, longest in ((5000, 1 << 20), (10**9, 1000), (0, 10)):
        got = [r.doc_id for r in Q.sample(docs, labels, most=most, longest=longest).collect()]
        assert all(size[i] <= longest or i == 3 for i in got) and sum(min(size[i], longest) for i in got) <= max(most, 0) + (10**9 if most == 10**9 else 0)
    assert len(Q.sample(docs, labels).collect()) == 29


def test_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "good words"), (3, "good words"), (None, "x"), (4, "BAD!! " * 40000)])
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.contract(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    none = Q.contract(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.contract(docs.limit(0), labels).count() == 0
