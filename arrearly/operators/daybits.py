"""Sets of days as bit masks, one bigint per 64 days, and rows counted by day, one row per 16 days.

A set of days per account is (account, chunk, days): chunk = day number div 64,
bit i of ``days`` = day chunk * 64 + i. ``bit_or`` builds it as a plain hash
aggregate with map-side combine, so any number of rows of a day costs 8 bytes, and
counting the days of an interval is a mask and a bit count, without
expanding rows for a distinct count.

Counts by day are (account, span, c0 .. c15): span = day number div 16, ci = the rows of day
span * 16 + i. They are plain counts, so an account's days travel as one row per span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS = 64
SPAN = 16


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def chunk_of(number: Column) -> Column:
    return F.floor(number / DAYS).cast("int")


def bit_of(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(DAYS)).cast("int"))


def day_sets(rows: DataFrame, key: str, day: Column, out: str = "days") -> DataFrame:
    """(key, chunk, out): the distinct days of each key. NULL days are in no set."""
    number = day_number(day)
    return (
        rows.where(day.isNotNull()).groupBy(key, chunk_of(number).alias("chunk"))
        .agg(F.bit_or(bit_of(number)).alias(out))
    )


def days_between(days: Column, chunk: Column, first: Column, last: Column) -> Column:
    """How many days of a chunk lie in [first, last] (dates); 0 where either is NULL."""
    start = chunk.cast("int") * DAYS
    lo = F.greatest(day_number(first) - start, F.lit(0))
    hi = F.least(day_number(last) - start, F.lit(DAYS - 1))
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), (F.lit(DAYS - 1) - (hi - lo)).cast("int"))
    mask = F.call_function("shiftleft", ones, lo.cast("int"))
    known = first.isNotNull() & last.isNotNull() & (lo <= hi)
    return F.when(known, F.bit_count(days.bitwiseAND(mask))).otherwise(F.lit(0)).cast("bigint")


def span_of(number: Column) -> Column:
    return F.floor(number / SPAN).cast("int")


def slot_of(number: Column) -> Column:
    return F.pmod(number, F.lit(SPAN))


def slot_counts(slot: Column, name: str) -> list[Column]:
    """Aggregates ``name``0 .. ``name``15: rows per slot; rows of a NULL slot are in none."""
    return [F.count(F.when(slot == i, F.lit(1))).alias(f"{name}{i}") for i in range(SPAN)]


def slot_products(a: str, b: str) -> Column:
    """The pairs of rows of two counts that share a day; NULL where a side is missing."""
    out = F.col(f"{a}0") * F.col(f"{b}0")
    for i in range(1, SPAN):
        out = out + F.col(f"{a}{i}") * F.col(f"{b}{i}")
    return out


def lowest(mask: Column) -> Column:
    """The place of a mask's lowest bit; of an empty mask NULL."""
    return F.when(mask != 0, F.instr(F.reverse(F.bin(mask)), "1") - 1)


def highest(mask: Column) -> Column:
    """The place of a mask's highest bit; of an empty mask NULL."""
    return F.when(mask != 0, F.length(F.bin(mask)) - 1)


def places(mask: Column) -> Column:
    """The places of a mask's bits, in order."""
    every = F.sequence(F.lit(0), F.lit(DAYS - 1))
    several = F.filter(every, lambda i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return F.when(F.bit_count(mask) == 1, F.array(lowest(mask))).otherwise(several)


def places_between(first: Column, last: Column) -> Column:
    """The mask of the places first .. last (both within 0 .. 63)."""
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(DAYS - 1) - (last - first))
    return F.call_function("shiftleft", ones, first)
