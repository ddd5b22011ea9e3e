"""Membership joins with SQL IN / NOT IN semantics, built for large key sets.

``x NOT IN (S)`` is null-aware: it is TRUE for every x when S is empty, NULL
(row dropped) when x is NULL or S holds a NULL and x is not found. Spark plans
the SQL form as a null-aware anti join that is always broadcast, whatever
the size of S. Here it is a ``left_anti`` join (sort-merge or shuffled hash
when S is large; AQE turns it into a broadcast only after measuring S) plus
two scalar existence tests that decide the NULL cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "loanAccountNumber"


def key_set(df: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct keys, one column named ``key``. Map-side partial aggregation
    collapses a hot key before the shuffle."""
    return df.select(key).distinct()


def semi(left: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """``left WHERE key IN (keys)``. A NULL in ``keys`` never makes IN true, and
    a NULL left key never matches, so a plain left-semi join is exact."""
    return left.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def semi_any(left: DataFrame, key_sets: list[DataFrame], key: str = KEY) -> DataFrame:
    """``key IN (S1) OR key IN (S2) ...`` as one semi join on the union."""
    u = None
    for s in key_sets:
        s = s.select(key)
        u = s if u is None else u.unionByName(s)
    return semi(left, u.distinct(), key)


def not_in(left: DataFrame, keys: DataFrame, key: str = KEY, keys_not_null: bool = False,
           left_not_null: bool = False, raw: DataFrame | None = None) -> DataFrame:
    """``left WHERE key NOT IN (keys)`` with exact SQL null semantics.

    ``keys_not_null`` may be set when the key set filters out NULL keys
    itself (or comes from an inner join on the key); the has-NULL test is
    then skipped. ``left_not_null`` says that ``left`` holds no NULL key; the
    is-empty test is then skipped. ``raw`` are rows that exist if and only if the key
    set has rows, for a set that is costly to compute: both tests read them
    instead (they need the key column only if NULL keys can occur).
    """
    k = F.col(key)
    kept = left.join(keys.select(key).where(k.isNotNull()), key, "left_anti")
    if left_not_null and keys_not_null:
        return kept
    keys = keys if raw is None else raw
    cond = F.lit(True) if left_not_null else k.isNotNull() | ~keys.exists()
    if not keys_not_null:
        cond = cond & ~keys.where(k.isNull()).exists()
    return kept.where(cond)


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` in which rows with a NULL key go around the join:
    they match nothing, and hashed by the key all of them would land in one task."""
    known = left.where(F.col(key).isNotNull()).join(right, key, "left")
    return known.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def left_join_spread(left: DataFrame, right: DataFrame, key: str, spread_by: str, ways: int = 256) -> DataFrame:
    """Left join on ``key`` in which rows with a NULL key, which match nothing,
    are dealt over ``ways`` values instead of one. For a ``left`` that is costly
    to read twice, and sides that are both shuffled for the join."""
    way = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(ways))).otherwise(F.lit(0).cast("bigint"))
    # Always 0 on the right; written so that the optimizer keeps it as a join key.
    zero = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    return left.withColumn("_way", way).join(right.withColumn("_way", zero), [key, "_way"], "left").drop("_way")


def mark(left: DataFrame, labelled: list[tuple[DataFrame, str]], out: str, default: str,
         key: str = KEY) -> DataFrame:
    """``CASE WHEN key IN (S1) THEN l1 WHEN key IN (S2) THEN l2 ... ELSE default``.

    The key sets are unioned with their priority, reduced to the best priority
    per key (partial aggregation), and joined once to ``left``.
    """
    parts = None
    for prio, (s, _label) in enumerate(labelled):
        p = s.select(F.col(key), F.lit(prio).alias("_prio")).where(F.col(key).isNotNull())
        parts = p if parts is None else parts.unionByName(p)
    best = parts.groupBy(key).agg(F.min("_prio").alias("_prio"))
    label: Column = F.lit(default)
    for prio, (_s, lab) in reversed(list(enumerate(labelled))):
        label = F.when(F.col("_prio") == prio, F.lit(lab)).otherwise(label)
    return left.join(best, key, "left").withColumn(out, label).drop("_prio")
