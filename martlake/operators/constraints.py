"""Table constraints checked before a write (primary key, not null, unique)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def constraint_violations(df: DataFrame, primary_key: list[str], not_null: list[str],
                          unique_cols: list[str]) -> DataFrame:
    """Pre-write constraint report: composite primary key, not null, unique.

    Primary key violations = rows beyond the first per key plus rows with a
    null key part; each is one grouped aggregate with map-side combine.
    """
    parts = []
    keyed = df.groupBy(*primary_key).agg(F.count(F.lit(1)).alias("n"))
    parts.append(keyed.agg(
        F.lit("primary_key").alias("constraint"),
        F.lit(",".join(primary_key)).alias("columns"),
        (F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
         + F.coalesce(F.sum(F.when(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in primary_key]),
                                     F.col("n"))), F.lit(0)))
        .cast("bigint").alias("violations")))
    parts.append(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
                 .select(F.explode(F.array(*[F.struct(F.lit("not_null").alias("constraint"),
                                                      F.lit(c).alias("columns"),
                                                      F.col(c).cast("bigint").alias("violations"))
                                             for c in not_null])).alias("s")).select("s.*"))
    for c in unique_cols:
        g = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(F.lit("unique").alias("constraint"), F.lit(c).alias("columns"),
                           F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations")))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("passed", F.col("violations") == 0)
