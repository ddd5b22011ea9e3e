"""Helpers shared by the training-data operators: table access, the shared
folder, text batches and vectorised word hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from arrearly.session import shared_dir

M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
PRIME = 0x100000001B3
PIECE = 1 << 19  # bytes hashed at once
BATCH_BYTES = 1 << 20  # text handled at once by a task


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's source to the executors' Python workers, once per
    Spark application; for clusters on which it is not installed."""
    sc = spark.sparkContext
    if not any(os.path.basename(f).startswith("arrearly-src-") for f in sc.listFiles):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        fd, path = tempfile.mkstemp(prefix="arrearly-src-", suffix=".zip")  # served by the driver, not shared
        with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share
    (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and read again
    by whatever follows, also after executors are lost."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key as text, modulo m (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % m


def mix(h: np.ndarray) -> np.ndarray:
    """Splitmix finaliser on uint64 (wraps on purpose)."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


_powers = {"pow": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}
_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * M3)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """PRIME**i and PRIME**-i modulo 2**64, i < n."""
    if len(_powers["pow"]) < n:
        size = max(n, PIECE + 4096)
        for name, base in (("pow", PRIME), ("inv", pow(PRIME, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["pow"], _powers["inv"]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of every span of a byte array; spans ascend and do
    not overlap. Works through pieces of about PIECE bytes, so memory does
    not follow the text's length."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + PIECE, side="right")))
        hi = int(ends[to - 1])
        pow_, inv = powers(hi - lo + 1)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[buf[lo:hi]] * pow_[: hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * M3)
        at = to
    return out


# Bytes of a word, after A-Z are lower-cased: digits, a-z and all of UTF-8 beyond ASCII,
# which is [^\x00-\x2F\x3A-\x60\x7B-\x7F] by code point.
WORD_BYTE = np.zeros(256, np.int8)
WORD_BYTE[0x30:0x3A] = 1
WORD_BYTE[0x61:0x7B] = 1
WORD_BYTE[0x80:] = 1


BLANKED = bytes(i if WORD_BYTE[i] else 0x20 for i in range(256))  # for bytes.translate(): all that is in no word


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class Words:
    """Words of a batch of texts: ``blob`` (lower-cased UTF-8, texts parted by
    a newline), ``starts``/``ends`` of words in it, their ``hashes``,
    ``offset`` of each text in the blob and ``bounds``: text i has the words
    bounds[i]:bounds[i+1]. A null text has no words."""

    def __init__(self, texts: list[str | bytes | None], hashed: bool = True):
        raw = [t if isinstance(t, bytes) else utf8(t) for t in texts]
        self.blob = b"\n".join(raw).lower()  # bytes.lower() changes A-Z only
        self.offset = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
        buf = np.frombuffer(self.blob, np.uint8)
        edges = np.flatnonzero(np.diff(WORD_BYTE[buf], prepend=np.int8(0), append=np.int8(0)))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.offset)
        self.hashes = span_hashes(buf, self.starts, self.ends) if hashed else None

    def word(self, i: int) -> bytes:
        return self.blob[self.starts[i]: self.ends[i]]

    def joined(self, i: int, j: int) -> bytes:
        return b" ".join([self.blob[s:e] for s, e in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist())])

    def last(self) -> np.ndarray:
        """For each word, the end of its text in word positions."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of n words inside one text."""
        at = np.flatnonzero(np.arange(len(self.starts)) + n <= self.last())
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * M3 + self.hashes[at + k]
        return at, mix(h)


def text_batches(texts: list[str | None] | pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``most`` bytes together (of a
    list: characters)."""
    if isinstance(texts, list):
        sizes = [len(t) if t else 0 for t in texts]
    else:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    lo, size = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` in text batches. ``fn`` gets a RecordBatch and returns
    a dict of columns (or None for no rows)."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for b in batches:
            for lo, hi in text_batches(b.column("text")) if "text" in b.schema.names else [(0, b.num_rows)]:
                got = fn(b.slice(lo, hi - lo))
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn, schema: StructType | None = None) -> DataFrame:
    """``mapInArrow`` that also takes columns with dots or backticks in their names,
    which ``mapInArrow`` itself cannot resolve: they travel under other names.
    ``schema`` is that of the result (None: of ``df``), where such columns must keep their place."""
    schema = schema or df.schema
    hard = {c: f"__col_{i}" for i, c in enumerate(df.columns) if "." in c or "`" in c}
    inside = StructType([StructField(hard.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    return df.toDF(*[hard.get(c, c) for c in df.columns]).mapInArrow(fn, inside).toDF(*schema.names)
