"""Range reads of a table: pages of a key, everything behind a cursor, a date range.

All are predicates or projections on the scan, so Spark prunes row groups and
splits the work itself; nothing is asked for page by page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_pages(df: DataFrame, key: str, page_size: int, first: int | None = None, pages: int | None = None) -> DataFrame:
    """Rows with the page of their key (``_page`` = key div ``page_size``); with ``first``
    and ``pages`` only those pages, as a key range that reaches the scan. A null
    key has a null page and is in no range."""
    if page_size < 1:
        raise ValueError("page_size must be positive")
    out = df
    if first is not None:
        out = out.where(F.col(key) >= first * page_size)
    if pages is not None:
        out = out.where(F.col(key) < ((first or 0) + pages) * page_size)
    return out.withColumn("_page", F.floor(F.col(key) / page_size).cast("bigint"))


def after_cursor(df: DataFrame, shard: str, key: str, cursors: dict) -> DataFrame:
    """Rows behind each shard's cursor (the last key already read), with ``_shard``.
    Shards without a cursor are read whole; null keys only then."""
    out = df.withColumn("_shard", F.col(shard))
    for name, last in cursors.items():
        out = out.where(~F.col(shard).eqNullSafe(F.lit(name)) | F.coalesce(F.col(key) > F.lit(last), F.lit(False)))
    return out


def date_range(df: DataFrame, column: str, after: str, until: str) -> DataFrame:
    """Rows with ``after`` < column <= ``until``; null dates are in no range."""
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (after, until))
    return df.where((F.col(column) > low) & (F.col(column) <= high))
