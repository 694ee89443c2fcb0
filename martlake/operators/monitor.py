"""Monitoring operators: freshness, reconciliation, distribution, anomalies,
alert routing and extraction thresholds.

Everything is a global or per-day aggregate; no operator joins row sets
pairwise. Single-row aggregates are combined by union + aggregate, and
row-level scoring reads the statistics as scalar subqueries (computed once,
then used as constants by every task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.functions.scalar import age_hours
from martlake.params import QualityParams
from martlake.sinks import snapshots as SN

QP = QualityParams()


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames with disjoint columns into one row (no join)."""
    cols = [c for f in frames for c in f.columns]
    padded = []
    for f in frames:
        padded.append(f.select(*[F.col(c) if c in f.columns else F.lit(None).alias(c) for c in cols]))
    # give the null columns their real types
    typed = []
    all_types = {c: t for f in frames for c, t in f.dtypes}
    for f in padded:
        typed.append(f.select(*[F.col(c).cast(all_types[c]).alias(c) for c in cols]))
    u = reduce(lambda a, b: a.unionByName(b), typed)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


# ------------------------------------------------------------------ C10

def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: str,
              limit_hours: float = QP.freshness_hours) -> DataFrame:
    """Per table: last load time, age in hours (2 digits), fresh if age < limit.

    Empty tables (null max) are stale with an error text. A load time after
    ``as_of`` gives a negative age and counts as fresh.
    """
    parts = []
    for name, (df, col) in tables.items():
        last = df.agg(F.max(col).cast("timestamp_ntz").alias("last_load"))
        age = age_hours(F.col("last_load"), as_of)
        parts.append(last.select(
            F.lit(name).alias("table"), "last_load", age.alias("age_hours"),
            F.coalesce(age < F.lit(limit_hours), F.lit(False)).alias("is_fresh"),
            F.when(F.col("last_load").isNull(), F.lit("no data")).alias("error")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness_of_loads(spark, tables: dict[str, str], as_of: str, limit_hours: float = QP.freshness_hours) -> DataFrame:
    """Freshness by load time: ``{name: path of a snapshot table}``. The load time is the
    ``loaded_at`` that each table's current commit notes; no row is read. A table
    that was never loaded is stale."""
    rows = []
    for name, path in tables.items():
        snap = SN.current(spark, path)
        loaded = snap.notes.get("loaded_at") if snap else None
        rows.append((name, loaded, None if loaded else "no load time" if snap else "never loaded"))
    found = spark.createDataFrame(rows, "`table` string, loaded string, error string") \
        .withColumn("last_load", F.col("loaded").cast("timestamp_ntz"))
    age = age_hours(F.col("last_load"), as_of)
    return found.select("table", "last_load", age.alias("age_hours"), F.coalesce(age < F.lit(limit_hours), F.lit(False)).alias("is_fresh"), "error")


def freshness_of_tables(spark, tables: dict[str, tuple[str, str]], as_of: str,
                        limit_hours: float = QP.freshness_hours) -> DataFrame:
    """Freshness by table location: ``{name: (parquet path or table name, column)}``.

    A table that cannot be read (missing, no such column) is reported stale
    with the error text instead of failing the whole check.
    """
    frames, broken = {}, []
    for name, (where, col) in tables.items():
        try:
            df = spark.read.parquet(where) if "/" in where else spark.table(where)
            df.select(col).schema  # resolve the column now
            frames[name] = (df, col)
        except Exception as e:  # noqa: BLE001 - reported per table, as a stale row
            broken.append((name, str(e)))
    parts = [freshness(frames, as_of, limit_hours)] if frames else []
    if broken:
        parts.append(spark.createDataFrame(
            [(n, None, None, False, err) for n, err in broken],
            "table string, last_load timestamp_ntz, age_hours double, is_fresh boolean, error string"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------------ C11

def reconcile(source: DataFrame, target: DataFrame, source_name: str, target_name: str,
              ratio: float = QP.reconcile_ratio, floor: int = QP.reconcile_floor) -> DataFrame:
    """|source - target| <= max(ratio * source, floor)."""
    counts = combine_rows(source.agg(F.count(F.lit(1)).alias("source_count")),
                          target.agg(F.count(F.lit(1)).alias("target_count")))
    diff = F.abs(F.col("source_count") - F.col("target_count"))
    tol = F.greatest(F.col("source_count").cast("double") * F.lit(ratio), F.lit(float(floor)))
    return counts.select(
        F.lit(source_name).alias("source"), F.lit(target_name).alias("target"),
        "source_count", "target_count", diff.alias("difference"), tol.alias("tolerance"),
        (diff <= tol).alias("passed"))


# ------------------------------------------------------------------ C12

def distribution(df: DataFrame, column: str, table: str, digits: int = 6) -> DataFrame:
    """avg, sample stddev, min, max, count over non-null values; null stats -> 0."""
    c = F.col(column)
    return df.agg(
        F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.round(F.coalesce(F.avg(c), F.lit(0.0)), digits).alias("mean"),
        F.round(F.coalesce(F.stddev_samp(c), F.lit(0.0)), digits).alias("stddev"),
        F.coalesce(F.min(c).cast("double"), F.lit(0.0)).alias("min"),
        F.coalesce(F.max(c).cast("double"), F.lit(0.0)).alias("max"),
        F.count(c).alias("count"))


# ------------------------------------------------------------------ C13

def zscore_rows(df: DataFrame, column: str, keys: list[str],
                limit: float = QP.zscore_limit, digits: int = 6) -> DataFrame:
    """Rows whose |z| exceeds ``limit`` against whole-column mean/stddev.

    The statistics are one scalar subquery (one extra aggregate pass),
    evaluated once and then constants for every partition, so the scoring pass
    is a narrow filter.
    """
    c = F.col(column)
    stats = df.select(F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s"))).scalar()
    # bind the subquery to one column so it appears (and runs) once
    scored = df.select(*keys, c.alias(column), stats.alias("_st"))
    std = F.col("_st.s")
    z = (F.col(column) - F.col("_st.m")) / F.when(std != 0, std)
    return (scored.select(*keys, column, z.alias("zscore"))
            .filter(F.abs("zscore") > F.lit(limit))
            .select(*keys, column, F.round("zscore", digits).alias("zscore")))


def metric_anomaly(daily: DataFrame, day: str, metric: str, trailing: int = QP.trailing_days,
                   limit: float = QP.zscore_limit, digits: int = 6) -> DataFrame:
    """z-score of a daily metric against the trailing ``trailing`` days.

    ``daily`` must already be one row per day; the window is then ordered over
    days only, so its single partition holds one row per day, not raw rows.
    """
    w = Window.orderBy(day).rowsBetween(-trailing, -1)
    m = F.avg(metric).over(w)
    s = F.stddev_samp(metric).over(w)
    scored = daily.select(day, metric, m.alias("trailing_mean"), s.alias("trailing_stddev"))
    z = (F.col(metric) - F.col("trailing_mean")) / F.when(F.col("trailing_stddev") != 0,
                                                          F.col("trailing_stddev"))
    return scored.select(
        day, metric,
        F.round("trailing_mean", digits).alias("trailing_mean"),
        F.round("trailing_stddev", digits).alias("trailing_stddev"),
        F.round(z, digits).alias("zscore"),
        F.coalesce(F.abs(z) > F.lit(limit), F.lit(False)).alias("is_anomaly"))


# ------------------------------------------------------------------ C14

def route_alerts(spark, freshness_df: DataFrame | None, reconcile_df: DataFrame | None) -> DataFrame:
    """Alert when any freshness or reconciliation result failed; a missing
    result counts as fine; distribution results are not consulted."""
    def ok(df, col, name):
        if df is None:
            return spark.range(1).select(F.lit(True).alias(name))
        return df.agg(F.coalesce(F.bool_and(col), F.lit(True)).alias(name))

    row = combine_rows(ok(freshness_df, "is_fresh", "freshness_ok"),
                       ok(reconcile_df, "passed", "reconcile_ok"))
    alert = ~(F.col("freshness_ok") & F.col("reconcile_ok"))
    return row.select("freshness_ok", "reconcile_ok", alert.alias("alert"),
                      F.when(alert, F.lit("alert")).otherwise(F.lit("ok")).alias("route"))


# ------------------------------------------------------------------ C15

def extraction_thresholds(required: dict[str, DataFrame], optional: dict[str, DataFrame]) -> DataFrame:
    """Counts per extracted table; required tables must be non-empty."""
    frames = [df.agg(F.count(F.lit(1)).alias(f"{n}_count")) for n, df in {**required, **optional}.items()]
    row = combine_rows(*frames)
    names = list(required) + list(optional)
    total = reduce(lambda a, b: a + b, [F.col(f"{n}_count") for n in names])
    ok = reduce(lambda a, b: a & b, [F.col(f"{n}_count") > 0 for n in required]) if required else F.lit(True)
    return row.select(*[f"{n}_count" for n in names], total.alias("total"), ok.alias("passed"))

