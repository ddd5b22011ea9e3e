"""Line dedup: of a line that several documents hold, only the document with
the smallest doc_id keeps it. DataFrame functions only.

Texts are split at newlines; a line's key is the line without white space
(space, tab to carriage return) at its ends and with A-Z lower-cased. Keys of
at least ``MIN_CHARS`` characters take part, as two 64-bit hashes.

Hash rows (hash, doc_id, position) are made of the texts once and written to the shared
folder; what follows reads those numbers. They are range-partitioned by hash and salt
and sorted by document and position, and a stream over each slice tells its first
document: lines of later documents go. A line has salts by its frequency: one that is
over a ``1 / SLICES`` of all rows is dealt by document over as many slices as it
has such parts, others stay whole, so no slice is larger. At most ``SLICES`` lines
are that frequent, which bounds the broadcast that names them; a sketch of frequent
items finds them, and a mistake of it would change the dealing only. Only the lines of
first documents (at most one document per slice) meet again by hash, where the
smallest of them stays. What comes back per document is a keep bitmap in run
lengths, not text; ``apply_bitmaps`` puts it to the text.

Defined results: a null or empty text is one empty line, which no key drops.
Rows with the same doc_id are one document for the rule, and each gets its own
result; a null doc_id is a document smaller than all others. Lines repeated
inside the smallest document stay. A document that loses every line keeps an
empty text. An empty table gives no rows. Other columns pass through, whatever
their names: helper columns start with ``__line_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

MIN_CHARS = 10
SLICES = 1_024
TRACKED = 16_384  # lines the sketch counts: its error is a small part of a slice
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HAS_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
BLANK = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANK))
    # lower() is the quicker way where a line is ASCII; elsewhere it would change more than A-Z.
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def frequent_lines(rows: DataFrame, slices: int = SLICES) -> DataFrame:
    """(h1, salts): lines with over a ``1 / slices`` of the rows, and their number of
    slices; at most ``slices`` of them."""
    top = F.call_function("approx_top_k", F.col("h1"), F.lit(slices), F.lit(max(TRACKED, slices)))
    found = rows.agg(top.alias("top"), F.count(F.lit(1)).alias("all")).select(F.explode("top").alias("t"), "all")
    salts = F.ceil(F.col("t.count") * slices / F.col("all")).cast("int")
    return found.select(F.col("t.item").alias("h1"), salts.alias("salts")).where("salts > 1")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, slices: int = SLICES) -> DataFrame:
    """(doc_id, text_hash, keep_bitmap, n_dropped) of every document that loses
    lines. keep_bitmap: run lengths of kept and dropped lines in turn,
    the first of kept lines; lines beyond the last run are kept."""
    rows = (docs.select("doc_id", _text_hash(F.col("text")).alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
            .select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "text_hash", "pos"))
    rows = written(rows, "lines")
    salted = rows.join(F.broadcast(frequent_lines(rows, slices)), "h1", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")), F.lit(0).cast("long")).cast("int")).drop("salts")
    slices_ = salted.repartitionByRange("h1", "h2", "salt")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "pos")
    seen = slices_.withColumn("first_doc", F.first("doc_id").over(stream))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_doc"))
    own = ["doc_id", "text_hash", "pos"]
    smallest = F.first("doc_id").over(Window.partitionBy("h1", "h2").orderBy("doc_id"))
    firsts = seen.where(is_first).withColumn("smallest", smallest).where(~F.col("doc_id").eqNullSafe(F.col("smallest")))
    drops = seen.where(~is_first).select(own).unionByName(firsts.select(own))
    gone = F.col("gone")
    begins = F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) < x - 1))
    lasts = F.filter(gone, lambda x, i: (i == F.size(gone) - 1) | (F.get(gone, i + 1) > x + 1))
    runs = F.col("runs")
    lengths = F.flatten(F.transform(runs, lambda r, i: F.array(
        r["begin"] - F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["last"] + 1), r["last"] - r["begin"] + 1)))
    return (drops.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
            .select("doc_id", "text_hash", "gone", F.arrays_zip(begins.alias("begin"), lasts.alias("last")).alias("runs"))
            .select("doc_id", "text_hash", lengths.alias("keep_bitmap"), F.size("gone").cast("long").alias("n_dropped")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with kept text in ``__line_kept`` and drop counts in
    ``__line_dropped``."""
    found = bitmaps.select(F.col("doc_id").alias("__line_doc"), F.col("text_hash").alias("__line_hash"),
                           F.col("keep_bitmap").alias("__line_bitmap"), F.col("n_dropped").alias("__line_n"))
    flags = F.flatten(F.transform("__line_bitmap", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    marked = F.arrays_zip(lines_of(F.col("text")).alias("line"), flags.alias("keep"))
    kept = F.transform(F.filter(marked, lambda x: F.coalesce(x["keep"], F.lit(True))), lambda x: x["line"])
    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__line_doc")) & (_text_hash(F.col("text")) == F.col("__line_hash")), "left")
    return (joined.withColumn("__line_kept", F.when(F.col("__line_bitmap").isNull(), text).otherwise(F.array_join(kept, "\n")))
            .withColumn("__line_dropped", F.coalesce("__line_n", F.lit(0).cast("long")))
            .drop("__line_doc", "__line_hash", "__line_bitmap", "__line_n"))


def dedup_lines(docs: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """``docs`` (its own columns) with the kept text; ``n_chars`` follows the
    text where there is such a column. A null text stays null.
    ``drop_emptied``: documents that lost lines and keep no word (all they say is in
    others) go; those that had no word before stay."""
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    if drop_emptied:
        out = out.where((F.col("__line_dropped") == 0) | F.col("__line_kept").rlike(HAS_WORD))
    new = {"text": F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col("__line_kept"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__line_dropped") > 0, F.length("__line_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def contract(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.col("__line_dropped").alias("n_dropped"),
        F.sha2("__line_kept", 256).alias("kept_sha256"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS smallest, bool_or(doc_id IS NULL) AS nameless FROM k WHERE length(key) >= {MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INTEGER) >= 2),
x AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS NOT NULL AND (f.nameless OR k.doc_id <> f.smallest) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM x GROUP BY rid, doc_id
"""
