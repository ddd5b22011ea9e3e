"""Source divergence audit: how far the word use of each source of a language is
from the other sources and from the language as a whole.

A term is a run of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z
lower-cased). Each language keeps the terms that at least ``MIN_DOCS`` of its
documents hold, V in all. A group is a (lang, source); with its count c of a kept
term and N, the sum of its counts over kept terms, the term's smoothed share is
p = 1 + floor(10^9 (c + 5) / (N + 5 V)), and q the same for the language.

* ``pair`` rows: for each other source of the language, the sum of abs(p - q)
  over the kept terms, q being the other source's share. Kept terms are dealt
  over buckets, sources over tiles; a task holds the shares of two tiles in one
  bucket as a matrix and returns a partial sum per pair. What no bucket of
  the tiles holds has the base share in both and is added as a product.
* ``term`` rows: the ``TOP`` terms with a count and p > q by falling p - q. A term
  is dominated by another with no smaller group count, no larger language
  count and an earlier UTF-8 form: that one ranks before it for certain. Each
  partition of a group retains its skyband (terms dominated by fewer than
  ``TOP`` others), skybands of a group are merged, and the merged one is ranked
  exactly. A term outside is dominated by ``TOP`` terms of the skyband, so nothing is lost.

Counting is partial in the tasks (whole texts, cut at term borders where they are
long) and again before the shuffle, so a hot source travels as one row per
task and term. All arithmetic is in whole numbers.

Defined results: null text, lang and source read as ''. Each row is a document, also
with a repeated or null doc_id. Every occurring group is reported, also without
terms. A group that is alone in its language has no pair rows; a language without kept terms
has pairs of value 0. Ties go to the item first in UTF-8. An empty table gives
no rows. Only text, lang and source are read.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8, written

MIN_DOCS = 30
TOP = 50
UNIT, SMOOTH = 1_000_000_000, 5
PIECE = 1 << 20  # bytes of a text split at once
HELD = 200_000  # terms a task counts before it hands them on
BUCKET = 2_048  # kept terms of a matrix
TILE = 64  # sources of a matrix
PART = 16_384  # kept terms of a first skyband

_TERM = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def pieces(text: bytes, most: int = PIECE):
    """``text`` (already blanked) in pieces that end between terms."""
    at = 0
    while at < len(text):
        end = at + most
        if end < len(text):
            blank = text.find(b" ", end)
            end = len(text) if blank < 0 else blank
        yield text[at:end]
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group."""
    given = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches):
        n: dict = {}
        held: dict = {}

        def flush():
            for lang, source in n:
                terms = list(n[lang, source])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n[lang, source].values()), pa.int64()),
                     pa.array([held[lang, source][t] for t in terms], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            n.clear()
            held.clear()

        for b in batches:
            for i in range(b.num_rows):
                key = b.column("lang")[i].as_py(), b.column("source")[i].as_py()
                blanked = utf8(b.column("text")[i].as_py()).lower().translate(_TERM)
                own: set = set()
                times = n.setdefault(key, Counter())
                for piece in pieces(blanked):
                    words = piece.split()
                    times.update(words)
                    own.update(words)
                held.setdefault(key, Counter()).update(own)
                if i % 64 == 63 or len(blanked) > PIECE:
                    if sum(map(len, n.values())) > HELD:
                        yield from flush()
        yield from flush()

    parts = given.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str):
    """The smoothed share, in decimals so that no product overflows."""
    return F.expr(f"1 + ((cast({count} + {SMOOTH} AS decimal(20,0)) * {UNIT}) div (cast({total} AS decimal(20,0)) + {SMOOTH} * {terms}))")


def skyband(n: np.ndarray, lang_n: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions of the items dominated by fewer than k others in larger n, smaller
    lang_n and smaller place (unique, the rank of the UTF-8 form)."""
    order = np.lexsort((place, lang_n, -n))  # whoever dominates comes first
    ln, pl = lang_n[order], place[order]
    band = np.zeros(0, np.int64)
    for at in range(0, len(order), 256):
        part = np.arange(at, min(at + 256, len(order)))
        over = ((ln[band][None, :] <= ln[part][:, None]) & (pl[band][None, :] < pl[part][:, None])).sum(axis=1)
        new = []
        for i, above in zip(part[over < k].tolist(), over[over < k].tolist()):
            if above + sum(1 for j in new if ln[j] <= ln[i] and pl[j] < pl[i]) < k:
                new.append(i)
        band = np.concatenate((band, np.array(new, np.int64)))
    return order[band]


def _skyband_rows(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    place = np.empty(len(pdf), np.int64)
    place[sorted(range(len(pdf)), key=[utf8(t) for t in pdf["term"]].__getitem__)] = np.arange(len(pdf))
    own = pdf.iloc[skyband(pdf["n"].to_numpy(), pdf["lang_n"].to_numpy(), place, k)]
    return own.astype({c: object for c in ("lang", "source", "term")})  # plain strings: large groups come in several Arrow chunks


def _kept(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms (lang, source, term, n, lang_n, v, p, q), and the groups
    (lang, source, number, base, v), base being the share of a count of 0."""
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(docs).select(
        "*", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"),
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("lead"))
    kept = written(counts.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"), "op13-kept")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("lead").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("number"),
                      *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "v")]))
    groups = written(groups.withColumn("base", F.when(F.col("v") > 0, share("0", "total", "v")).otherwise(zero)), "op13-groups")
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "number", "term", "n", "lang_n", "v", share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q"))
    return shares, groups


def _pairs(shares: DataFrame, groups: DataFrame, bucket: int, tile: int) -> DataFrame:
    buckets = F.greatest(F.lit(1), F.ceil(F.col("v") / bucket)).cast("int")
    own_tile = F.expr(f"(number - 1) div {tile}")
    tiles = groups.groupBy("lang").agg((F.max(own_tile) + 1).alias("tiles"))
    cells = (shares.select("lang", "source", "number", "term", F.col("p").alias("share"), F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"))
             # a row without a term tells each bucket the group and its base
             .unionByName(groups.select("lang", "source", "number", F.lit(None).cast("string").alias("term"), F.col("base").alias("share"),
                                        F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket")))
             .withColumn("tile", own_tile).join(tiles, "lang")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .select("lang", "source", "number", "term", "share", "bucket",
                     F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")))

    def sums(key, pdf):
        known = pdf[pdf["term"].isna()].sort_values("number")
        rest = pdf[pdf["term"].notna()]
        column, names = pd.factorize(rest["term"])
        grid = np.repeat(known["share"].to_numpy(np.int64)[:, None], len(names), axis=1)
        numbers = known["number"].to_numpy()
        grid[np.searchsorted(numbers, rest["number"].to_numpy()), column] = rest["share"].to_numpy(np.int64)
        in_tile = (numbers - 1) // tile
        source, base = known["source"].to_numpy(object), known["share"].to_numpy(np.int64)
        out: list[list] = [[], [], [], []]
        for i in np.flatnonzero(in_tile == key[1]).tolist():
            js = np.flatnonzero((in_tile == key[2]) & (numbers > numbers[i]))
            gap = np.abs(base[js] - base[i])
            own = np.abs(grid[js] - grid[i]).sum(axis=1) - gap * len(names)
            for held, new in zip(out, ([source[i]] * len(js), source[js].tolist(), own.tolist(), gap.tolist())):
                held += new
        return pd.DataFrame(dict(zip(("a", "b", "part", "gap"), out))).assign(lang=key[0])[["lang", "a", "b", "part", "gap"]].astype(object)

    parts = cells.groupBy("lang", "low", "high", "bucket").applyInPandas(sums, "lang string, a string, b string, part long, gap long")
    both = (parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.max("gap").alias("gap"))
            .join(groups.groupBy("lang").agg(F.max("v").alias("v")), "lang")
            .withColumn("value", F.col("part") + F.col("gap") * F.col("v")))
    return both.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value").select(
        "lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")


def _terms(shares: DataFrame, top: int, part: int) -> DataFrame:
    rows = shares.where(F.col("p") > F.col("q")).select("lang", "source", "term", "n", "lang_n", (F.col("p") - F.col("q")).alias("value"), "v")
    schema = "lang string, source string, term string, n long, lang_n long, value long, slice int, merged int"
    parts = F.greatest(F.lit(1), F.ceil(F.col("v") / part)).cast("int")
    # First skybands per slice of a group, then of about 32 slices, then of the group.
    out = rows.withColumn("slice", F.pmod(F.xxhash64("term"), parts).cast("int")).withColumn("merged", F.expr("slice div 32")).drop("v")
    out = out.groupBy("lang", "source", "slice").applyInPandas(lambda pdf: _skyband_rows(pdf, top), schema)
    out = out.groupBy("lang", "source", "merged").applyInPandas(lambda pdf: _skyband_rows(pdf, top), schema)
    return out.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, bucket: int = BUCKET, tile: int = TILE, part: int = PART) -> DataFrame:
    """(lang, source, part, item, value, rank), see above."""
    shares, groups = _kept(docs, min_docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    terms = _terms(shares, top, part).withColumn("rank", rank).where(F.col("rank") <= top)
    return _pairs(shares, groups, bucket, tile).withColumn("rank", rank).unionByName(terms)


def contract(docs: DataFrame) -> DataFrame:
    return audit(docs)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= {MIN_DOCS}),
c AS (SELECT o.lang, o.source, o.term, count(*) AS c FROM o JOIN k ON o.lang = k.lang AND o.term = k.term GROUP BY o.lang, o.source, o.term),
lt AS (SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM k GROUP BY lang),
gt AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + ({UNIT}::HUGEINT * (coalesce(c.c, 0) + {SMOOTH})) // (coalesce(gt.n, 0) + {SMOOTH} * lt.v) AS p,
             1 + ({UNIT}::HUGEINT * (k.c + {SMOOTH})) // (lt.n + {SMOOTH} * lt.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN lt ON lt.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
r AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
             CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
