"""Stupid-backoff scores of documents against n-gram counts of the corpus.

Counts are tables of (n-gram hash, count) partitioned by the hash; the
n-grams of documents are joined to them and the logarithms summed per
document. To keep rows few, n-grams travel in blocks: documents are dealt by
hash over blocks of about ``BLOCK_CHARS`` characters, and a block sends, for
every order and hash partition, one row with its distinct n-gram hashes (sorted, as
differences) and counts. Texts go to their blocks as compressed words. A hash partition adds up the counts of all blocks
and sends each block the totals of what it asked for, in the same order; a
block then scores its documents. A frequent n-gram is one entry per
block, so no task's input follows a key's frequency. Nothing is pruned, and
the tables grow with the corpus.

Score of a word w after its context, with the longest n-gram tried first:
c(context w) / c(context) if c(context w) > 0, else ``BACKOFF`` times the
score with a context shorter by one word; for one word c(w) / N, and 1 / N for
a word that nobody else has. All counts leave out the document itself
(``leave_out``), as else every n-gram of the corpus would be known. A
document's score is the sum of log10 over its words, in millionths: what a
word adds without N, and log10 of N, are rounded to whole numbers first, so the
sum does not depend on the order of adding.

Words: A-Z lower-cased, maximal runs of digits, a-z and non-ASCII. n-grams are
64-bit hashes of them.

Defined results: a null or empty text, or one without words, has n_words 0 and
score 0; N is 1 at least (a corpus of one document). Repeated rows are documents
of their own, which know each other. An empty table gives no rows. Only
doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKED, Words, text_batches, utf8, written

ORDER = 3
BACKOFF = 0.4
BLOCK_CHARS = 8_000_000
PART_CHARS = 16_000_000  # text whose n-grams of one order make a hash partition, about
FLUSH_CHARS = 16_000_000
UNIT = 1_000_000
BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("words", pa.binary())])
SCORES = "doc_id long, n_words long, micro_log10 long, n_backed_off long"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    width = 8
    while width > 1 and not planes[width - 1].any():
        width -= 1
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes[:width].tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, : blob[0]] = raw.T
    return out.view("<u8").ravel()


def packed_sorted(hashes: np.ndarray) -> bytes:
    return packed(np.diff(hashes, prepend=np.uint64(0)))


def unpacked_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


class Grams:
    """n-grams of a block's documents: for each order the distinct hashes, the
    number of each position's n-gram (that ends there, or -1) and counts."""

    def __init__(self, texts: list[bytes], order: int):
        w = Words(texts)
        self.bounds, self.n = w.bounds, len(w.starts)
        self.orders = []
        for k in range(1, order + 1):
            at, h = w.windows(k)
            distinct, which, count = np.unique(h, return_inverse=True, return_counts=True)
            number = np.full(self.n, -1, np.int64)
            number[at + k - 1] = which
            self.orders.append((distinct, number, count))

    def slices(self, distinct: np.ndarray, bits: int):
        """(hash partition, from, to): partitions are ranges of the hash."""
        part = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        return list(zip(part[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(part)]))

    def own_counts(self, number: np.ndarray) -> np.ndarray:
        """For each position, how often its own document has its n-gram."""
        doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        key = doc * (int(number.max(initial=0)) + 2) + number + 1
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        return count[which]


def _to_blocks(batches):
    """Compressed words of the documents of a task, one row per block and
    about FLUSH_CHARS characters."""

    def rows(held):
        cols = [list(c) for c in zip(*[(block, ids, zstandard.ZstdCompressor(level=3).compress(b"\n".join(texts))) for block, (ids, texts) in held.items()])]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.binary())], schema=BLOCKS)

    held, size = {}, 0
    for batch in batches:
        for lo, hi in text_batches(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            for block, doc, text in zip(*[part.column(c).to_pylist() for c in ("block", "doc_id", "text")]):
                ids, texts = held.setdefault(block, ([], []))
                ids.append(doc)
                texts.append(utf8(text).lower().translate(BLANKED))
                size += len(texts[-1])
            if size >= FLUSH_CHARS:
                yield rows(held)
                held, size = {}, 0
    if held:
        yield rows(held)


def _documents(tbl: pa.Table) -> tuple[list, list[bytes]]:
    """doc_ids and words of the documents of a block's rows."""
    ids = [i for own in tbl.column("ids").to_pylist() for i in own]
    texts = [t for blob in tbl.column("words").to_pylist() for t in zstandard.ZstdDecompressor().decompress(blob).split(b"\n")]
    return ids, texts


def _requests(order: int, bits: int):
    schema = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def run(key, tbl):
        grams = Grams(_documents(tbl)[1], order)
        rows = []
        for k, (distinct, _, count) in enumerate(grams.orders):
            rows += [(key[0].as_py(), (k << 32) + p, packed_sorted(distinct[a:b]), packed(count[a:b])) for p, a, b in grams.slices(distinct, bits)]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _totals(key, tbl):
    """Adds up one hash partition's counts; the totals for each block."""
    blocks = tbl.column("block").to_pylist()
    hashes = [unpacked_sorted(b) for b in tbl.column("hashes").to_pylist()]
    counts = [unpacked(b) for b in tbl.column("counts").to_pylist()]
    ends = np.cumsum([len(h) for h in hashes])
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts).astype(np.float64)).astype(np.int64)[which]
    blobs = [packed(t) for t in np.split(total, ends[:-1])]
    return pa.table({"block": pa.array(blocks, pa.int64()), "part": pa.array([key[0].as_py()] * len(blocks), pa.int64()),
                     "totals": pa.array(blobs, pa.binary())})


def _score(order: int, backoff: float, leave_out: bool):
    def run(key, docs, answers):
        ids, texts = _documents(docs) if docs.num_rows else ([], [])
        grams = Grams(texts, order)
        sizes = np.diff(grams.bounds)
        parts = sorted(zip(answers.column("part").to_pylist(), answers.column("totals").to_pylist())) if answers.num_rows else []
        known = []  # per order: count of the n-gram that ends at each position, without the document's own
        for k, (_, number, _) in enumerate(grams.orders):
            own = [unpacked(b) for p, b in parts if p >> 32 == k]
            total = np.concatenate([*own, np.zeros(1, np.uint64)]).astype(np.int64)  # the last is for positions without one
            known.append(total[number] - (np.where(number >= 0, grams.own_counts(number), 0) if leave_out else 0))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(grams.n) - grams.bounds[:-1][doc]
        p = np.maximum(known[0], 1).astype(np.float64)  # still to be divided by N
        level = np.zeros(grams.n, np.int64)
        for k in range(1, order):
            up = (place >= k) & (known[k] > 0)
            context = np.concatenate(([0], known[k - 1]))[: grams.n]
            p = np.where(up, known[k] / np.maximum(context, 1), p)
            level = np.where(up, k, level)
        steps = np.minimum(order - 1, place) - level
        micro = np.rint((np.log10(p) + steps * np.log10(backoff)) * UNIT).astype(np.int64)
        a, b = grams.bounds[:-1], grams.bounds[1:]
        sums = [np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in (micro, level == 0, steps > 0)]
        return pa.table([pa.array(x, pa.int64()) for x in (ids, sizes, *[x[b] - x[a] for x in sums])],
                        names=["doc_id", "n_words", "micro", "n_single", "n_backed_off"])

    return run


def _dealt(docs: DataFrame, block_chars: int, part_chars: int) -> tuple[DataFrame, int]:
    """Documents dealt to blocks, and the bits of the hash that number a partition."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).mapInArrow(_to_blocks, "block long, ids array<long>, words binary")
    return dealt, (chars // part_chars).bit_length()


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, leave_out: bool = True,
          block_chars: int = BLOCK_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per document (columns of ``SCORES``): its words, the sum of
    their log10 scores in millionths, and how many backed off."""
    dealt, bits = _dealt(docs.select("doc_id", "text"), block_chars, part_chars)
    answers = (dealt.groupBy("block").applyInArrow(_requests(order, bits), "block long, part long, hashes binary, counts binary")
               .groupBy("part").applyInArrow(_totals, "block long, part long, totals binary"))
    scored = written(dealt.groupBy("block").cogroup(answers.groupBy("block"))
                     .applyInArrow(_score(order, backoff, leave_out), SCORES.replace("micro_log10", "micro") + ", n_single long"), "lm-scores")
    n_all = scored.agg(F.sum("n_words")).first()[0] or 0
    rest = F.greatest(F.lit(n_all) - (F.col("n_words") if leave_out else 0), F.lit(1))
    total = F.col("micro") - F.col("n_single") * F.rint(F.log10(rest) * UNIT).cast("long")
    return scored.select("doc_id", "n_words", total.alias("micro_log10"), "n_backed_off")


def _table(key, tbl):
    """One hash partition's distinct n-grams with their counts."""
    hashes = np.concatenate([unpacked_sorted(b) for b in tbl.column("hashes").to_pylist()])
    counts = np.concatenate([unpacked(b) for b in tbl.column("counts").to_pylist()])
    distinct, which = np.unique(hashes, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, counts.astype(np.int64))
    order = (key[0].as_py() >> 32) + 1
    return pa.table({"n": pa.array(np.full(len(distinct), order, np.int32)), "hash": pa.array(distinct.view(np.int64)), "count": pa.array(total)})


def count_table(docs: DataFrame, order: int = ORDER, block_chars: int = BLOCK_CHARS, part_chars: int = PART_CHARS) -> DataFrame:
    """(n, hash, count): how often the corpus has each n-gram of 1 to ``order`` words, by
    its 64-bit hash. Every n-gram is in it. Written as a table, it is a model that other
    documents are scored against (``score_against``)."""
    docs = docs.select("doc_id", "text")
    dealt, bits = _dealt(docs, block_chars, part_chars)
    return (dealt.groupBy("block").applyInArrow(_requests(order, bits), "block long, part long, hashes binary, counts binary")
            .groupBy("part").applyInArrow(_table, "n int, hash long, count long"))


def _lookup(key, asked, known):
    """The table's counts of what each block asks for in one hash partition."""
    hashes = known.column("hash").to_numpy().view(np.uint64) if known.num_rows else np.zeros(0, np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    counts = np.append(known.column("count").to_numpy()[order] if known.num_rows else np.zeros(0, np.int64), 0)
    blobs = []
    for blob in asked.column("hashes").to_pylist():
        want = unpacked_sorted(blob)
        at = np.searchsorted(hashes, want)
        hit = np.append(hashes, np.uint64(0))[at] == want
        blobs.append(packed(counts[np.where(hit & (at < len(hashes)), at, len(hashes))]))
    n = asked.num_rows
    return pa.table({"block": asked.column("block"), "part": pa.array([key[0].as_py()] * n, pa.int64()), "totals": pa.array(blobs, pa.binary())})


def score_against(docs: DataFrame, counts: DataFrame, order: int = ORDER, backoff: float = BACKOFF, block_chars: int = BLOCK_CHARS,
                  part_rows: int = 2_000_000) -> DataFrame:
    """Scores of ``docs`` (columns of ``SCORES``) against a count table of any corpus
    (``count_table``): the table is partitioned by hash and joined to the n-grams of
    each block of documents. An n-gram the table lacks counts 0. The documents' own
    counts are not taken out: they need not be in that corpus. N is the table's
    number of words, 1 at least."""
    docs = docs.select("doc_id", "text")
    rows, n_all = counts.agg(F.count(F.lit(1)), F.sum(F.when(F.col("n") == 1, F.col("count")))).first()
    dealt, _ = _dealt(docs, block_chars, PART_CHARS)
    bits = (rows // part_rows).bit_length()
    asked = dealt.groupBy("block").applyInArrow(_requests(order, bits), "block long, part long, hashes binary, counts binary")
    slot = F.call_function("shiftrightunsigned", F.col("hash"), F.lit(64 - bits)) if bits else F.lit(0).cast("long")
    known = counts.where(F.col("n") <= order).select(((F.col("n") - 1) * F.lit(1 << 32) + slot).alias("part"), "hash", "count")

    def answer(key, asks, table):
        return _lookup(key, asks, table) if asks.num_rows else pa.table({"block": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "totals": pa.array([], pa.binary())})

    answers = asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(answer, "block long, part long, totals binary")
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(order, backoff, False), SCORES.replace("micro_log10", "micro") + ", n_single long")
    total = F.col("micro") - F.col("n_single") * F.rint(F.log10(F.lit(max(n_all or 0, 1))) * UNIT).cast("long")
    return scored.select("doc_id", "n_words", total.alias("micro_log10"), "n_backed_off")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contract(docs: DataFrame) -> DataFrame:
    return score(docs).select("doc_id", "n_words", "micro_log10", "n_backed_off")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS ws FROM documents),
t0 AS (SELECT rid, unnest(ws) AS w3, unnest(range(len(ws))) AS pos FROM d),
t AS (SELECT *, lag(w3, 1) OVER own AS w2, lag(w3, 2) OVER own AS w1 FROM t0 WINDOW own AS (PARTITION BY rid ORDER BY pos)),
n AS (SELECT count(*) AS total FROM t),
s AS (SELECT rid, len(ws) AS size FROM d),
u AS (SELECT w3 AS x, count(*) AS c FROM t GROUP BY ALL), ud AS (SELECT rid, w3 AS x, count(*) AS c FROM t GROUP BY ALL),
b AS (SELECT w2 AS x, w3 AS y, count(*) AS c FROM t WHERE pos >= 1 GROUP BY ALL),
bd AS (SELECT rid, w2 AS x, w3 AS y, count(*) AS c FROM t WHERE pos >= 1 GROUP BY ALL),
g AS (SELECT w1, w2, w3, count(*) AS c FROM t WHERE pos >= 2 GROUP BY ALL),
gd AS (SELECT rid, w1, w2, w3, count(*) AS c FROM t WHERE pos >= 2 GROUP BY ALL),
k AS (SELECT t.rid, t.pos, greatest(n.total - s.size, 1) AS rest,
        u.c - ud.c AS c3, v.c - vd.c AS c2, b.c - bd.c AS c23, a.c - ad.c AS c12, g.c - gd.c AS c123
      FROM t CROSS JOIN n JOIN s ON s.rid = t.rid
      JOIN u ON u.x = t.w3 JOIN ud ON ud.rid = t.rid AND ud.x = t.w3
      LEFT JOIN u v ON v.x = t.w2 LEFT JOIN ud vd ON vd.rid = t.rid AND vd.x = t.w2
      LEFT JOIN b ON b.x = t.w2 AND b.y = t.w3 LEFT JOIN bd ON bd.rid = t.rid AND bd.x = t.w2 AND bd.y = t.w3
      LEFT JOIN b a ON a.x = t.w1 AND a.y = t.w2 LEFT JOIN bd ad ON ad.rid = t.rid AND ad.x = t.w1 AND ad.y = t.w2
      LEFT JOIN g ON g.w1 = t.w1 AND g.w2 = t.w2 AND g.w3 = t.w3
      LEFT JOIN gd ON gd.rid = t.rid AND gd.w1 = t.w1 AND gd.w2 = t.w2 AND gd.w3 = t.w3),
p AS (SELECT rid, CASE WHEN pos >= 2 AND c123 > 0 THEN 0 WHEN pos >= 1 AND c23 > 0 THEN least(pos, 2) - 1 ELSE least(pos, 2) END AS steps,
        NOT coalesce(pos >= 2 AND c123 > 0 OR pos >= 1 AND c23 > 0, false) AS single, rest,
        CASE WHEN pos >= 2 AND c123 > 0 THEN c123 / c12 WHEN pos >= 1 AND c23 > 0 THEN c23 / c2 ELSE greatest(c3, 1) END AS p FROM k),
r AS (SELECT rid, sum(CAST(round_even((log10(p) + steps * log10({BACKOFF})) * {UNIT}, 0) AS BIGINT)
          - CASE WHEN single THEN CAST(round_even(log10(rest) * {UNIT}, 0) AS BIGINT) ELSE 0 END) AS m,
        sum(CAST(steps > 0 AS INTEGER)) AS f FROM p GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(r.m, 0) AS BIGINT) AS micro_log10, CAST(coalesce(r.f, 0) AS BIGINT) AS n_backed_off
FROM d LEFT JOIN r ON r.rid = d.rid
"""
