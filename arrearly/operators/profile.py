"""Column profile of a result: type and non-null count per column, and the
row count, from a single aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """One row per column: (position, column_name, data_type, non_null, rows)."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(rows))
