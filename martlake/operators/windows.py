"""Ledgers of processed time windows: islands, gaps, and the next window to load.

A window is half open, [start, end). Windows of one group (a pipeline, a table) that
touch or overlap are one island. Both functions are one sort per group over
windows, of which a group has few; they never see the rows that were loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(windows: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(by..., start, end, windows): the coalesced windows. Empty ones (end <= start) and
    those with a null bound cover nothing."""
    real = windows.where(F.col(start) < F.col(end))
    order = Window.partitionBy(*by).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = real.withColumn("_opens", F.when(reached.isNull() | (F.col(start) > reached), 1).otherwise(0))
    numbered = opens.withColumn("_island", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end),
                                                F.count(F.lit(1)).alias("windows")).drop("_island")


def gaps(windows: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(by..., start, end): the stretches between a group's first start and last end
    that no window covers."""
    order = Window.partitionBy(*by).orderBy(start)
    after = islands(windows, by, start, end).withColumn("_next", F.lead(start).over(order))
    return after.where(F.col("_next").isNotNull()).select(*by, F.col(end).alias(start), F.col("_next").alias(end))


def covered(found: list[list[str]], start: str, end: str) -> list[list[str]]:
    """The ledger of one pipeline, a short list of [start, end] texts in one sortable
    form, after one more window."""
    out: list[list[str]] = []
    for a, z in sorted([*found, [start, end]]):
        if a >= z:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def first_gap(found: list[list[str]], start: str, end: str) -> tuple[str, str] | None:
    """The earliest stretch of [start, end) that the ledger lacks."""
    at = start
    for a, z in found:
        if a > at:
            return at, min(a, end)
        at = max(at, z)
        if at >= end:
            return None
    return (at, end) if at < end else None
