"""A bounded bit filter of a key set, to drop rows of other keys before a shuffle.

Each key sets one bit of ``bits`` (a power of two) by its hash. The bits are one array of bigints,
at most ``bits / 8`` bytes however many keys there are, read by the tasks
as a scalar subquery. A row whose bit is not set is certainly of another key; one
whose bit is set may still be, so an exact join or aggregation follows. A
filter of far more keys than bits lets everything pass, and results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # 1 MB: some 3 million keys leave two thirds of the others out


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)).cast("bigint")


def may_hold(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """Condition on rows with a column ``key``: may the key be one of ``keys``.
    A NULL key is never held."""
    assert bits >= 64 and bits & (bits - 1) == 0
    place = _place(key, bits)
    words = (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.call_function("shiftright", place, F.lit(6)).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))).alias("set"))
    )
    # At most bits / 64 words: a bounded array, in order, gaps filled with 0.
    slots = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    filled = (
        slots.join(words, "word", "left")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set")))), lambda x: x["set"]).alias("bits"))
    )
    own = F.get(filled.scalar(), F.call_function("shiftright", place, F.lit(6)).cast("int"))
    hit = F.call_function("shiftrightunsigned", own, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return F.col(key).isNotNull() & hit
