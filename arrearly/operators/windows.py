"""Per-group row numbering that does not put a hot group into one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` hash-partitions on ``g``:
a group holding a third of the rows becomes one straggler task. Here a group
is cut into slices that follow the order (such as days): rows are numbered
within (group, slice), and a table of counts per (group, slice), summed up over
the slices before, gives each slice its offset. The numbers depend on the
rows alone, not on how they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_number_by_slice(df: DataFrame, group: str, slice_by: Column, order: list[str], out: str = "rnk") -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``group`` by
    ``order`` (ascending, NULLs first; the order columns should make rows
    unique). ``slice_by`` must not fall along the order. A NULL group is a
    group, and a NULL slice the first of its group."""
    own = df.withColumn("_slice", slice_by)
    counts = own.groupBy(F.col(group).alias("_group"), F.col("_slice").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col("_slice").eqNullSafe(F.col("_of"))
    return (
        own.withColumn("_within", within).join(offsets, same)
        .withColumn(out, (F.col("_within") + F.col("_offset")).cast("bigint"))
        .drop("_slice", "_within", "_group", "_of", "_offset")
    )
