"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start, end, name: str = "date_day") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    Reversed bounds give no rows (Spark's ``sequence`` would raise, so the
    bounds are checked first).
    """
    s = start if isinstance(start, Column) else F.lit(start).cast("date")
    e = end if isinstance(end, Column) else F.lit(end).cast("date")
    return spark.range(1).select(
        F.explode(F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
                  .otherwise(F.array().cast("array<date>"))).alias(name))


def date_spine_between(bounds: DataFrame, start_col: str, end_col: str,
                       name: str = "date_day") -> DataFrame:
    """Spine from bounds computed by Spark (a one-row DataFrame)."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    return bounds.select(
        F.explode(F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
                  .otherwise(F.array().cast("array<date>"))).alias(name))
