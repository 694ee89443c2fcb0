"""Pipeline-health queries of the dashboard and the table inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_COLUMNS = ["run_id", "pipeline_name", "status", "start_time", "end_time",
               "rows_processed", "rows_loaded", "error_message"]


def runs_from_events(events: DataFrame) -> DataFrame:
    """Run-log rows derived from the event table (one run per event)."""
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("pipeline_name"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("INTERVAL 60 SECONDS")).alias("end_time"),
        F.col("user_id").alias("rows_processed"),
        F.when(failed, F.lit(0).cast("bigint")).otherwise(F.col("user_id")).alias("rows_loaded"),
        F.when(failed, F.concat(F.lit("error event "), F.col("event_id").cast("string"))).alias("error_message"))


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` runs; a missing start time sorts first, as in SQL DESC."""
    return (runs.orderBy(F.desc_nulls_first("start_time"), F.desc("run_id")).limit(n)
            .select("pipeline_name", "status", "start_time", "end_time",
                    "rows_processed", "rows_loaded", "error_message"))


def run_status_summary(latest: DataFrame) -> DataFrame:
    """Counts over the rows shown (the latest ``n`` only)."""
    return latest.agg(F.count(F.lit(1)).alias("total_runs"),
                      F.count_if(F.col("status") == "success").alias("successful_runs"),
                      F.count_if(F.col("status") == "failed").alias("failed_runs"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
                   for name, df in tables.items()])
