"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates, scored as sparse dot products.

Features of a text: its tokens (runs of letters and digits, runs of
punctuation) as unigrams and bigrams, hashed to ``2**BITS`` weights. Tokens
are lower-cased; a word of two or more capitals is the token ``<caps>``
besides, and a token equal to its predecessor is ``<same>``, so shouting and
repetition are n-grams like others. A feature's value is its share of the text's
n-grams times ``SCALE``; a text without tokens has the bias alone.

Training (FTRL-proximal, per-coordinate rates) uses a bounded sample of labelled
documents, whole texts: those with the smallest hash of doc_id among the labelled ids that
have a document, at most ``TRAIN_ROWS`` of them, none over ``TEXT_BYTES``, and
``TRAIN_BYTES`` in all. The sample is chosen by ids and sizes; only its texts move. They are
dealt to ``TRAIN_SHARDS`` tasks that each see every feature of their rows for
``EPOCHS`` passes; the mean of their weights is the model, 2**BITS floats,
which is broadcast. Scores read only the text.

Defined results: null and empty texts get the bias's score; without any
labelled row all scores are 0.5; labels without a document, null labels and
null doc_ids do not train and displace no one; a doc_id labelled twice trains with its largest
label, and one with several rows with its smallest text; repeated documents repeat in the scores. Only doc_id, text and quality are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import M3, arrow_map, crc_mod, mix, span_hashes, text_batches

BITS = 18
SCALE = 16.0
TRAIN_ROWS = 8_000
TRAIN_BYTES = 128 << 20
TEXT_BYTES = 1 << 20
TRAIN_SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 1.0

# Classes of bytes: 1 letters, digits and UTF-8 beyond ASCII, 2 punctuation, 0 white space and control.
_CLASS = np.zeros(256, np.int8)
_CLASS[0x21:0x7F] = 2
_CLASS[0x30:0x3A] = _CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SAME, _CAPS = mix(np.array([101, 103], np.uint64))


def features(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams of the texts, the text of each, and the
    n-grams per text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(raw), np.uint8)
    kind = _CLASS[buf]
    edge = np.flatnonzero(np.diff(kind, prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[:-1], edge[1:]
    token = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[token], ends[token]
    offset = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
    doc = np.searchsorted(offset, starts, side="right") - 1
    h = span_hashes(_LOWER[buf], starts, ends)
    upper = np.concatenate(([0], np.cumsum((buf >= 0x41) & (buf <= 0x5A))))
    small = np.concatenate(([0], np.cumsum((buf >= 0x61) & (buf <= 0x7A))))
    caps = (upper[ends] - upper[starts] >= 2) & (small[ends] == small[starts])
    follows = np.zeros(len(h), bool)
    follows[1:] = doc[1:] == doc[:-1]
    same = np.zeros(len(h), bool)
    same[1:] = follows[1:] & (h[1:] == h[:-1])
    word = np.where(same, _SAME, h)
    pair = np.flatnonzero(follows)
    all_ = np.concatenate((word, mix(word[pair - 1] * M3 + word[pair]), np.full(int(caps.sum()), _CAPS)))
    docs = np.concatenate((doc, doc[pair], doc[caps]))
    return (all_ >> np.uint64(64 - bits)).astype(np.int64), docs, np.bincount(docs, minlength=len(texts))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[str], labels: list[int], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal passes over the texts; the last is the bias."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows = []
    for lo, hi in text_batches(texts):
        f, d, count = features(texts[lo:hi], bits)
        order = np.argsort(d, kind="stable")
        for own, c in zip(np.split(f[order], np.cumsum(count)[:-1]), count):
            idx, times = np.unique(own, return_counts=True)
            rows.append((np.append(idx, size - 1), np.append(times * (SCALE / max(c, 1)), 1.0)))

    def weights(z_, n_):
        return np.where(np.abs(z_) <= L1, 0.0, -(z_ - np.sign(z_) * L1) / ((BETA + np.sqrt(n_)) / ALPHA + L2))

    for _ in range(epochs):
        for (idx, x), y in zip(rows, labels):
            w = weights(z[idx], n[idx])
            g = (sigmoid(w @ x) - y) * x
            z[idx] += g - (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / ALPHA * w
            n[idx] += g * g
    return weights(z, n)


def sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, most: int = TRAIN_BYTES,
           longest: int = TEXT_BYTES) -> DataFrame:
    """(doc_id, y): the documents to learn from (see above), ``rows`` at most."""
    order = [F.xxhash64("doc_id"), "doc_id"]
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
             .select(F.col("doc_id").cast("long").alias("doc_id"), "y"))
    # Ids alone decide who is in the corpus, so labels of other documents take no place.
    here = docs.where(F.col("doc_id").isNotNull() & (F.octet_length(F.coalesce("text", F.lit(""))) <= longest)).groupBy("doc_id").agg(
        F.max(F.octet_length(F.coalesce("text", F.lit("")))).alias("size"))
    chosen = known.join(here, "doc_id").orderBy(*order).limit(rows)
    sofar = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))  # over ``rows`` pairs of numbers at most
    return chosen.withColumn("sofar", sofar).where(F.col("sofar") <= most).select("doc_id", "y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, shards: int = TRAIN_SHARDS) -> np.ndarray:
    """The model of a bounded sample of labelled rows (see above)."""
    known = sample(docs, labels, label, rows)
    # ``rows`` pairs of numbers at most, so a broadcast is bounded, and only the texts of the sample move.
    texts = docs.where(F.octet_length(F.coalesce("text", F.lit(""))) <= TEXT_BYTES).select("doc_id", "text").join(F.broadcast(known), "doc_id")
    once = texts.groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    dealt = once.withColumn("shard", F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(shards)))

    def one(pdf):
        pdf = pdf.sort_values("doc_id")
        w = train([t or "" for t in pdf["text"]], pdf["y"].tolist())
        return pd.DataFrame({"weights": [w.astype(np.float32).tobytes()], "n": [len(pdf)]})

    parts = dealt.groupBy("shard").applyInPandas(one, "weights binary, n long").collect()  # ``shards`` rows of fixed size
    if not parts:
        return np.zeros((1 << BITS) + 1)
    return np.average([np.frombuffer(p["weights"], np.float32) for p in parts], axis=0, weights=[p["n"] for p in parts])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row; reads the text only."""
    known = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    bits = (len(weights) - 1).bit_length() - 1

    def run(batch):
        w = known.value
        texts = batch.column("text").to_pylist()
        f, d, count = features(texts, bits)
        dot = np.bincount(d, weights=w[f], minlength=len(texts)) * SCALE / np.maximum(count, 1)
        return {"doc_id": batch.column("doc_id").to_pylist(), "score": sigmoid(dot + w[-1])}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, score double")


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = crc_mod(F.col("doc_id"), 3) == 1
    model = fit(docs, labels.where(~held))
    return score(docs, model).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
