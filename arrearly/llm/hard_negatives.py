"""Hard-negative mining by a secondary sort.

Every component is made a whole number, ``floor(SCALE * x)``, so a score is an
exact integer inner product. An anchor's positives are its ``POSITIVES`` best
rows of the same label. Each positive opens a window [low * its score, its score],
and the first ``NEGATIVES`` rows of other labels inside it are its hard
negatives; higher scores come first, ties by smaller vec_id.

Scored pairs travel as packed keys (anchor, descending score, positives before
negatives, id), 33 bytes that sort as they should. They are partitioned by
anchor and sorted within partitions (in the JVM, spilling); an iterator over
a partition opens windows as positives pass and hands out negatives at
once, so it holds the open windows of one anchor, whatever the anchor's size.

Not every pair travels. Anchors are a stated query set: they go to the
tasks in broadcasts of at most ``ANCHOR_BYTES`` (counted first; more anchors
mean more passes), and each task scores its rows against them in
matrix blocks. It hands on its best positives per anchor, and, once the global
positives are known, the first negatives of each of their windows. Whatever is
not among the first ``NEGATIVES`` of a window in its own task cannot be among the
first of all.

Defined results: rows with a null vec_id or label, or a vector that is null or holds
a null or non-finite component, take no part. Vectors of different lengths do
not meet. Rows with the anchor's vec_id are never its partners; other
repeated rows each count, and an anchor row repeated exactly is one anchor. An
anchor without positives, or without rows of another label, gives no rows, as
does an empty table. Components beyond 2^62 after scaling are cut to that, and
scores beyond a long to a long. Only vec_id, label and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW = (80, 100)  # a window's lower end, as parts of the positive's score
ANCHOR_BYTES = 32 << 20
ROWS, PANEL = 4_096, 512  # rows and anchors of a score matrix
EDGE = 1 << 62
KEYS = "anchor long, key binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def valid(rows: DataFrame) -> DataFrame:
    e: Column = F.col("embedding")
    # NaN is larger than infinity for Spark, so the test rejects it.
    finite = F.forall(e, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & finite))


def quantise(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as whole numbers: int64, or Python's where products could
    leave a long. Exact in float64 too while the sums stay below 2^53."""
    with np.errstate(over="ignore"):
        q = np.clip(np.floor(vectors.astype(np.float64) * scale), -float(EDGE), float(EDGE))
    most = np.abs(q).max(initial=0.0)
    if most * most * q.shape[1] < 2.0**52:
        return q
    if most * most * q.shape[1] < 2.0**62:
        return q.astype(np.int64)
    return np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape)


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products as int64 (rows by anchors). Both sides stay in the
    narrowest form in which every product and sum is exact."""
    bound = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * rows.shape[1]
    if bound < 2.0**52:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    if bound < 2.0**62:
        return rows.astype(np.int64) @ anchors.astype(np.int64).T
    whole = rows.astype(object) @ anchors.astype(object).T
    ends = np.iinfo(np.int64)
    return np.array([[min(max(int(x), ends.min), ends.max) for x in row] for row in whole], dtype=np.int64).reshape(whole.shape)


def first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first by falling score, then id."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], ~score[at]))[:k]]  # ~x falls as x rises, without overflow


def in_window(negative, positive):
    """Is a negative's score inside a positive's window (whole numbers, no overflow)."""
    return LOW[0] * int(positive) <= LOW[1] * int(negative) <= LOW[1] * int(positive)


def lowest(positive: int) -> int:
    """The least whole score inside the window of a positive."""
    return -(-LOW[0] * int(positive) // LOW[1])


def _unsigned(x: int) -> bytes:
    return (int(x) + (1 << 63)).to_bytes(8, "big")


def pack(vec_id: int, anchor: int, score: int, negative: bool, other: int) -> bytes:
    return _unsigned(vec_id) + _unsigned(anchor) + _unsigned(-1 - int(score)) + bytes([negative]) + _unsigned(other)


def unpack(key: bytes) -> tuple[int, int, int, bool, int]:
    a, n, s, o = (int.from_bytes(key[i: i + 8], "big") - (1 << 63) for i in (0, 8, 16, 25))
    return a, n, -1 - s, bool(key[24]), o


class Anchors:
    """A batch of anchors as matrices by vector length; ``first_no`` numbers them."""

    def __init__(self, rows: pa.Table, first_no: int = 0):
        self.groups: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self.windows: dict[int, list[int]] = {}  # anchor number -> scores of its positives
        vectors = [np.asarray(v, np.float64) for v in rows.column("embedding").to_pylist()]
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        sizes = np.array([len(v) for v in vectors], np.int64)
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            self.groups[size] = (at + first_no, ids[at], labels[at], quantise(np.stack([vectors[i] for i in at.tolist()]).reshape(len(at), size)))


def blocks(batch: pa.RecordBatch, rows: int = ROWS):
    """(ids, labels, vectors) of the rows of each vector length, in blocks."""
    for lo in range(0, batch.num_rows, rows):
        part = batch.slice(lo, rows)
        column = part.column("embedding")
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            own = part.take(pa.array(np.flatnonzero(sizes == size)))
            flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False)
            yield own.column("vec_id").to_numpy(), own.column("label").to_numpy(), quantise(flat.reshape(own.num_rows, size))


def _score_rows(rows: DataFrame, known, negatives: bool, k: int) -> DataFrame:
    """Packed keys of each task's first k positives per anchor, or of its first
    k negatives per window."""

    def run(batches):
        anchors: Anchors = known.value
        best: dict = {}  # (anchor number[, window]) -> (scores, ids, row numbers)
        owner: dict[int, int] = {}
        done = 0

        def add(slot, score, ids, row):
            if slot in best:
                score, ids, row = (np.concatenate(x) for x in zip(best[slot], (score, ids, row)))
            keep = first(score, ids, k)
            best[slot] = score[keep], ids[keep], row[keep]

        for batch in batches:
            for ids, labels, vectors in blocks(batch):
                row = np.arange(done, done + len(ids))
                done += len(ids)
                if vectors.shape[1] not in anchors.groups:
                    continue
                numbers, own_ids, own_labels, matrix = anchors.groups[vectors.shape[1]]
                for lo in range(0, len(numbers), PANEL):
                    found = scores(vectors, matrix[lo: lo + PANEL])
                    for j, a in enumerate(numbers[lo: lo + PANEL].tolist()):
                        score = found[:, j]
                        other = ids != own_ids[lo + j]
                        owner[a] = int(own_ids[lo + j])
                        if not negatives:
                            at = np.flatnonzero((labels == own_labels[lo + j]) & other)
                            if len(at):
                                add(a, score[at], ids[at], row[at])
                            continue
                        tops = anchors.windows.get(a, [])
                        if not tops:
                            continue
                        at = np.flatnonzero((labels != own_labels[lo + j]) & other & (score <= tops[0]) & (score >= min(map(lowest, tops))))
                        for w, top in enumerate(tops):
                            inside = at[(score[at] <= top) & (score[at] >= lowest(top))]
                            if len(inside):
                                add((a, w), score[inside], ids[inside], row[inside])
        merged: dict[int, list] = {}
        for slot, got in best.items():
            merged.setdefault(slot[0] if negatives else slot, []).append(got)
        out_a, out_key = [], []
        for a, got in merged.items():
            score, ids, row = (np.concatenate(x) for x in zip(*got))
            _, at = np.unique(row, return_index=True)  # a row may be in several windows
            for i in at.tolist():
                out_a.append(a)
                out_key.append(pack(owner[a], a, score[i], negatives, ids[i]))
            if len(out_a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_key, pa.binary())], names=["anchor", "key"])
                out_a, out_key = [], []
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_key, pa.binary())], names=["anchor", "key"])

    return rows.mapInArrow(run, KEYS)


def stream(keys, positives: int, negatives: int):
    """Reads keys in order. Yields ("positive", anchor id, anchor number, place, id,
    score) and ("negative", anchor id, positive, rank, id, score) as they
    pass, holding the open windows of one anchor."""
    last, seen, windows = None, 0, []
    for key in keys:
        anchor_id, number, score, is_negative, other = unpack(key)
        if (anchor_id, number) != last:
            last, seen, windows = (anchor_id, number), 0, []
        if not is_negative:
            if seen < positives:
                seen += 1
                windows.append([other, score, 0])
                yield "positive", anchor_id, number, seen, other, score
            continue
        windows = [w for w in windows if w[2] < negatives and LOW[0] * w[1] <= LOW[1] * score]
        for w in windows:
            w[2] += 1
            yield "negative", anchor_id, (w[0], w[1]), w[2], other, score


def _sorted(keys: DataFrame) -> DataFrame:
    return keys.repartition("anchor").sortWithinPartitions("key")


def _keys_of(batches):
    for b in batches:
        yield from b.column("key").to_pylist()


def _chunks(rows, names, types, size=20_000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of each anchor's positives and their first hard negatives among ``rows``."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    rows = valid(rows)
    asked = written(valid(anchors).distinct(), "op11-anchors")
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("embedding") * 8 + 64), F.lit(0))).first()
    passes = max(1, -(-size // anchor_bytes))
    out = spark.createDataFrame([], RESULT)
    number = 0

    def best(batches):
        got = (r[1:] for r in stream(_keys_of(batches), positives, 0))
        yield from _chunks(got, ["anchor_id", "anchor", "place", "other", "score"], [pa.int64()] * 5)

    def mined(batches):
        got = ((r[1], r[2][0], r[3], r[4], r[2][1], r[5]) for r in stream(_keys_of(batches), positives, negatives) if r[0] == "negative")
        yield from _chunks(got, [f.split()[0] for f in RESULT.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])

    for p in range(passes if count else 0):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p).toArrow()  # about ``anchor_bytes``
        known = Anchors(part, number)
        number += part.num_rows
        own = written(_sorted(_score_rows(rows, sc.broadcast(known), False, positives))
                      .mapInArrow(best, "anchor_id long, anchor long, place long, other long, score long"), "op11-positives")
        for r in own.orderBy("anchor", "place").toArrow().to_pylist():  # ``positives`` rows per anchor of this pass
            known.windows.setdefault(r["anchor"], []).append(r["score"])
        found = _score_rows(rows, sc.broadcast(known), True, negatives)

        def packed(batches):
            for b in batches:
                rows_ = b.to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["anchor"] for r in rows_], pa.int64()),
                     pa.array([pack(r["anchor_id"], r["anchor"], r["score"], False, r["other"]) for r in rows_], pa.binary())], names=["anchor", "key"])

        out = out.unionByName(_sorted(own.mapInArrow(packed, KEYS).unionByName(found)).mapInArrow(mined, RESULT))
    return out


def contract(embeddings: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), "embedding")
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


SQL = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.no, a.vec_id AS anchor_id, e.vec_id AS id, e.label = a.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM (SELECT row_number() OVER () AS no, * FROM (SELECT DISTINCT * FROM e WHERE vec_id % 100 = 0)) a JOIN e ON a.vec_id <> e.vec_id AND len(a.v) = len(e.v)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.no, p.place ORDER BY s.score DESC, s.id) AS rank,
             s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.no = p.no AND NOT s.same AND {LOW[0]} * p.score <= {LOW[1]} * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
