"""Benchmark decontamination: find benchmark word windows in documents and
remove the spans or the documents.

Texts are normalised to words (A-Z lower-cased, maximal runs of digits, a-z
and non-ASCII). A window is ``n`` consecutive words of an item; an item of
fewer words, but not none, is one window. The windows form a hash set that
is broadcast while the items are below ``BROADCAST_CHARS`` characters
together (counted first); a scan tests every word window of every document
against it and verifies each hit word by word. Beyond the bound a bit filter of the
items' windows is broadcast instead (``FILTER_BITS``, whatever their number): a document's
window travels only if its bit is set, and those that do meet the items' windows in a shuffle
join on the window's own words.

Defined results: a null or empty text has no words and is clean; items with
null text or no words have no windows; a null item_id is named ``null``;
repeated items are named once; repeated documents give repeated rows; an
empty benchmark leaves every document clean; a document whose every word is cut out as a
span stays, with what is left of its text. Only the columns ``doc_id`` and
``text`` are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_map, map_rows, text_batches, written

WINDOW = 10
BROADCAST_CHARS = 4_000_000
FILTER_BITS = 27  # 16 MB: ten million windows leave nine in ten others out
HITS = ("doc_id long, n_words long, n_hit long, n_items long, item_ids array<string>, "
        "spans array<struct<start:int,end:int>>, contaminated boolean")


class WindowSet:
    """Windows of the items: words -> item ids, with a bit filter on hashes."""

    BITS = 22

    def __init__(self, items: list[tuple[str, str | None]], n: int = WINDOW):
        self.windows: dict[bytes, set[str]] = {}
        hashes: dict[int, list[int]] = {}
        for lo, hi in text_batches([t for _, t in items]):
            w = Words([t for _, t in items[lo:hi]])
            for k in range(hi - lo):
                a, b = int(w.bounds[k]), int(w.bounds[k + 1])
                size = min(n, b - a)
                for i in range(a, b - size + 1) if size else ():
                    self.windows.setdefault(w.joined(i, i + size), set()).add(items[lo + k][0])
            short = {min(n, int(x)) for x in np.diff(w.bounds)} - {0}
            for size in short:
                at, h = w.windows(size)
                own = np.minimum(n, np.diff(w.bounds))[np.searchsorted(w.bounds, at, side="right") - 1] == size
                hashes.setdefault(size, []).extend(h[own].tolist())
        self.sizes = {}
        for size, h in sorted(hashes.items()):
            known = np.unique(np.array(h, np.uint64))
            bits = np.zeros(1 << self.BITS, bool)
            bits[known >> np.uint64(64 - self.BITS)] = True
            self.sizes[size] = (known, bits)

    def occurrences(self, w: Words):
        """(first word, length, item ids) of verified hits."""
        for size, (known, bits) in self.sizes.items():
            at, h = w.windows(size)
            maybe = np.flatnonzero(bits[h >> np.uint64(64 - self.BITS)])
            if len(maybe):
                pos = np.searchsorted(known, h[maybe])
                maybe = maybe[known[np.minimum(pos, len(known) - 1)] == h[maybe]]
            for i in at[maybe].tolist():
                found = self.windows.get(w.joined(i, i + size))
                if found:
                    yield i, size, found


def digest(w: Words, hits, ids: list) -> dict:
    """Result columns of a batch from its hits (first word, length, item ids)."""
    n = len(ids)
    marks = np.zeros(len(w.starts) + 1, np.int32)
    items: list[set[str]] = [set() for _ in range(n)]
    for i, size, found in hits:
        marks[i] += 1
        marks[i + size] -= 1
        items[int(np.searchsorted(w.bounds, i, side="right")) - 1] |= found
    hit = np.cumsum(marks[:-1]) > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    n_hit = total[w.bounds[1:]] - total[w.bounds[:-1]]
    spans = []
    for k in range(n):
        own = []
        if n_hit[k]:
            a, b, lo = int(w.bounds[k]), int(w.bounds[k + 1]), int(w.offset[k])
            edges = np.flatnonzero(np.diff(hit[a:b].astype(np.int8), prepend=0, append=0))
            for s, e in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                start = len(w.blob[lo: w.starts[a + s]].decode("utf-8", "replace"))
                own.append({"start": start, "end": start + len(w.blob[w.starts[a + s]: w.ends[a + e - 1]].decode("utf-8", "replace"))})
        spans.append(own)
    return {"doc_id": ids, "n_words": np.diff(w.bounds), "n_hit": n_hit, "n_items": [len(x) for x in items],
            "item_ids": [sorted(x) for x in items], "spans": spans, "contaminated": n_hit > 0}


def _small(benchmark: DataFrame, bound: int) -> bool:
    return (benchmark.agg(F.sum(F.length("text") + 16)).first()[0] or 0) <= bound


def _item_rows(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text").where("text is not null")


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """One row per document: word and hit counts, the items found and the
    character spans of hit words (columns of ``HITS``)."""
    docs = docs.select("doc_id", "text")
    if _small(benchmark, broadcast_chars):
        known = _broadcast(benchmark, n)

        def scan(batch):
            w = Words(batch.column("text").to_pylist())
            return digest(w, known.value.occurrences(w), batch.column("doc_id").to_pylist())

        return arrow_map(docs, scan, HITS)
    return _joined(docs, benchmark, n)


def _broadcast(benchmark: DataFrame, n: int):
    rows = [(r["item"], r["text"]) for r in _item_rows(benchmark).collect()]  # bounded by the count before
    return benchmark.sparkSession.sparkContext.broadcast(WindowSet(rows, n))


def window_filter(items: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bits of the items' window hashes (column ``hash``), 2**bits of them. Gathered by words of
    64 bits, so at most 2**(bits - 6) rows of two numbers reach the driver."""
    place = F.call_function("shiftrightunsigned", F.col("hash"), F.lit(64 - bits))
    words = (items.groupBy(F.call_function("shiftright", place, F.lit(6)).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))).alias("set")).toArrow())
    out = np.zeros(1 << max(bits - 6, 0), np.uint64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    return out


def may_occur(known: np.ndarray, hashes: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (known[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _joined(docs: DataFrame, benchmark: DataFrame, n: int, bits: int = FILTER_BITS) -> DataFrame:
    """The same for a benchmark beyond the bound: windows meet in a join."""
    window = "item string, size int, words string, hash long"

    def own(batch):
        w, ids = Words(batch.column("text").to_pylist()), batch.column("item").to_pylist()
        out = {"item": [], "size": [], "words": [], "hash": []}
        by_size = {}
        for k, item in enumerate(ids):
            a, b = int(w.bounds[k]), int(w.bounds[k + 1])
            size = min(n, b - a)
            if size and size not in by_size:
                by_size[size] = dict(zip(*(x.tolist() for x in w.windows(size))))
            for i in range(a, b - size + 1) if size else ():
                h = by_size[size][i]
                for c, v in zip(out, (item, size, w.joined(i, i + size).decode(), h - (1 << 64) if h >> 63 else h)):
                    out[c].append(v)
        return out

    items = written(arrow_map(_item_rows(benchmark), own, window).distinct(), "windows")
    sizes = [r[0] for r in items.select("size").distinct().collect()]  # n values at most
    known = docs.sparkSession.sparkContext.broadcast(window_filter(items, bits))
    items = items.drop("hash")

    def windows(batch):
        w, keys = Words(batch.column("text").to_pylist()), batch.column("key").to_pylist()
        out = {"key": [], "at": [], "size": [], "words": []}
        for size in sizes:
            at, h = w.windows(size)
            at = at[may_occur(known.value, h, bits)]
            k = np.searchsorted(w.bounds, at, side="right") - 1
            out["key"] += [keys[x] for x in k.tolist()]
            out["at"] += (at - w.bounds[k]).tolist()
            out["size"] += [size] * len(at)
            out["words"] += [w.joined(i, i + size).decode() for i in at.tolist()]
        return out

    keyed = docs.withColumn("key", F.sha2("text", 256))
    texts = keyed.where("text is not null").dropDuplicates(["key"]).select("key", "text")
    hits = (arrow_map(texts, windows, "key string, at int, size int, words string").join(items, ["size", "words"])
            .groupBy("key").agg(F.collect_set(F.struct("at", "size", "item")).alias("hits")))

    def scan(batch):
        w = Words(batch.column("text").to_pylist())
        found = [(int(w.bounds[k]) + h["at"], h["size"], {h["item"]})
                 for k, hs in enumerate(batch.column("hits").to_pylist()) for h in hs or ()]
        return digest(w, found, batch.column("doc_id").to_pylist())

    return arrow_map(keyed.join(hits, "key", "left").select("doc_id", "text", "hits"), scan, HITS)


def without_spans(text: str | None, spans) -> str | None:
    """The text without the given character spans (ascending)."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in spans:
        out.append(text[at: s["start"]])
        at = s["end"]
    return "".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW,
                  broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """``docs`` (all its columns) without the contaminated documents, or with
    the hit spans cut out of ``text`` (``remove="spans"``). A benchmark
    beyond the bound is joined, with rows matched by the hash of their text."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove!r}")
    if not _small(benchmark, broadcast_chars):
        texts = docs.select(F.xxhash64("text").alias("doc_id"), "text").where("text is not null").dropDuplicates(["doc_id"])
        hits = _joined(texts, benchmark, n).where("contaminated").select(F.col("doc_id").alias("__hit"), F.col("spans").alias("__spans"))
        same = F.xxhash64("text") == F.col("__hit")
        if remove == "documents":
            return docs.join(hits, same, "left_anti").select(docs.columns)

        def cut_batches(batches):
            for b in batches:
                spans = b.column("__spans").to_pylist()
                cut = pa.array([without_spans(t, s) for t, s in zip(b.column("text").to_pylist(), spans)], b.schema.field("text").type)
                b = b.drop_columns(["__spans"])
                yield b.set_column(b.schema.get_field_index("text"), "text", cut)

        return map_rows(docs.join(hits, same, "left").drop("__hit"), cut_batches, docs.schema)
    known = _broadcast(benchmark, n)

    def run(batches):
        for b in batches:
            for lo, hi in text_batches(b.column("text")):
                part = b.slice(lo, hi - lo)
                texts = part.column("text").to_pylist()
                w = Words(texts)
                got = digest(w, known.value.occurrences(w), [None] * len(texts))
                if remove == "documents":
                    yield part.filter(pa.array(~got["contaminated"]))
                else:
                    cut = pa.array([without_spans(t, s) for t, s in zip(texts, got["spans"])], part.schema.field("text").type)
                    yield part.set_column(part.schema.get_field_index("text"), "text", cut)

    return map_rows(docs, run)


def contract(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of ``op2``: counts and a hash of the item ids."""
    return find_hits(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS ws FROM benchmark),
bi AS (SELECT item, ws, least({WINDOW}, len(ws)) AS size, unnest(range(len(ws) - least({WINDOW}, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, size, array_to_string(list_slice(ws, i + 1, i + size), ' ') AS w FROM bi),
di AS (SELECT rid, ws, size, unnest(range(greatest(len(ws) - size + 1, 0))) AS i FROM d CROSS JOIN (SELECT DISTINCT size FROM bw)),
dw AS (SELECT rid, i, size, array_to_string(list_slice(ws, i + 1, i + size), ' ') AS w FROM di),
h AS (SELECT dw.rid, dw.i, dw.size, bw.item FROM dw JOIN bw ON dw.size = bw.size AND dw.w = bw.w),
p AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS pos FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.rid = d.rid LEFT JOIN t ON t.rid = d.rid
"""
