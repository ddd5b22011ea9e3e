"""Best-fit packing of documents into training sequences.

Every document becomes token ids plus an end id; documents over the
sequence length are cut into full pieces, the first piece taking the
remainder. Short pieces are dealt over shards and each shard packs its own, in
falling order of length: of the open sequences in which a piece fits under
every capacity (tokens, documents, attention cost, the sum of squared piece
lengths) it takes the one with the smallest weighted norm of what stays free.
Token ids never move: pieces carry lengths and a checksum, 60 bytes each.

A shard holds about ``SHARD_PIECES`` short pieces (counted first), so a
task's memory is bounded and at most a few sequences per shard stay partly
free. Full pieces are sequences of their own and only get a number, where they
stand: no group of rows is made of them.

Defined results: a null or empty text is its end id alone; repeated rows are
packed once each; an empty table gives no rows. Short pieces are dealt by a hash of
(doc_id, checksum, start), so the order of rows does not matter to them. Sequence ids
are shard * 2**32 + number; those of full pieces have a negative shard, one
for each partition of the table of pieces, and follow its order.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map, written

LENGTH = 1024
END = 2
MAX_DOCS = 1024  # documents in a sequence
MAX_ATTENTION = 1024 * 1024  # sum of squared piece lengths
WEIGHTS = (1.0, 0.05, 0.1)  # of free tokens, documents, attention
SHARD_PIECES = 6000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", shard long, sequence long, offset long"


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first is short."""
    first = n % length or min(n, length)
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    def run(batch):
        out = {k.split()[0]: [] for k in PIECES.split(", ")}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = np.append(tokens.encode(text, vocabulary), np.uint32(end)).astype("<u4", copy=False)
            for k, (start, size) in enumerate(cut(len(ids), length)):
                for c, v in zip(out, (doc, k, start, size, zlib.crc32(ids[start: start + size].tobytes()))):
                    out[c].append(v)
        return out

    return arrow_map(docs.select("doc_id", "text"), run, PIECES)


def best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; sizes must fall. What a piece
    takes of the capacities: its length, one document, its squared length."""
    need = np.stack([sizes, np.ones_like(sizes), sizes * sizes]).astype(np.float64)
    free = np.zeros((3, len(sizes)))
    scale = weights / capacity
    number, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    low = opened = 0  # sequences before low take no piece any more
    least = need.min(axis=1) if len(sizes) else None
    for i in range(len(sizes)):
        left = free[:, low:opened] - need[:, i: i + 1]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            norm = np.einsum("c,cj->j", scale * scale, left * left)
            norm[~fits] = np.inf
            j = low + int(norm.argmin())
        else:
            j, opened = opened, opened + 1
            free[:, j] = capacity
        number[i], offset[i] = j, capacity[0] - free[0, j]
        free[:, j] -= need[:, i]
        while low < opened and (free[:, low] < least).any():
            low += 1
    return number, offset


def pack(found: DataFrame, length: int = LENGTH, max_docs: int = MAX_DOCS, max_attention: int = MAX_ATTENTION,
         weights: tuple = WEIGHTS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Sequence and offset for every piece (columns of ``PIECES``)."""
    capacity, w = np.array([length, max_docs, max_attention], np.float64), np.array(weights)
    names = [x.split()[0] for x in PACKED.split(", ")]
    found = written(found, "pieces")  # counted and dealt
    shards = max(1, -(-found.where(F.col("length") < length).count() // shard_pieces))

    def fit(key, pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        number, offset = best_fit(pdf["length"].to_numpy(np.int64), capacity, w)
        return pdf.assign(sequence=number, offset=offset)[names]

    row = found.where(F.col("length") == length).withColumn("row", F.monotonically_increasing_id())  # partition * 2**33 + place
    full = row.withColumn("shard", -1 - F.shiftright("row", 33)).withColumn("sequence", F.col("row").bitwiseAND(F.lit((1 << 33) - 1)))
    full = full.withColumn("offset", F.lit(0).cast("long")).select(*names)
    dealt = found.where(F.col("length") < length).withColumn("shard", F.pmod(F.xxhash64("doc_id", "ids_crc32", "start", "length"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(fit, PACKED).unionByName(full)


def contract(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs)).select("doc_id", "piece", "start", "length", "ids_crc32",
                                     (F.col("shard") * (1 << 32) + F.col("sequence")).alias("sequence_id"), "offset")
