"""Connected components of a link table by alternating large-star and
small-star rounds (Kiveris et al.), every round written to the shared folder.

Links and labels stay distributed; only one count and one checksum per round
reach the driver, to see whether the round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import removed, saved


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")) \
        .unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    near = _neighbours(edges)
    if not large:
        near = near.where(F.col("v") < F.col("u"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = near.join(least, "u")
    if large:
        out = out.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = out.select(F.col("m").alias("a"), F.col("v").alias("b")) \
            .unionAll(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", paths: list[str] | None = None) -> DataFrame:
    """(node, component) for every node that has a link; the component is its
    smallest node. Self links, null ends and repeated links are ignored; an
    empty link table gives an empty result. A round's links go when the next has
    been saved; ``paths`` gets the path of the last, which the result reads."""
    spark, last = edges.sparkSession, []
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))).distinct()
    edges, before = saved(edges, "cc", last), None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now[0] == 0 or now == before:
            break
        before, used, last = now, last, []
        edges = saved(_star(_star(edges, large=True), large=False), "cc", last)
        removed(spark, used)
    if paths is not None:
        paths += last
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")) \
        .unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
