"""Control tables: high-water marks and the run log.

Marks are a small table keyed by (pipeline_name, table_name); saving one is an
upsert on that key. The run log is appended by a context manager that records
start, end, status and row counts (row counts come from an ``Observation`` on
the written frame, so counting costs no extra job); with a path it is a table that
outlives the session.
"""

from __future__ import annotations

import datetime as dt
import json
import traceback
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlake.operators.merge import upsert
from martlake.sinks import snapshots as SN

MARK_SCHEMA = "pipeline_name string, table_name string, watermark_value string, updated_at timestamp_ntz"
MARK_KEYS = ["pipeline_name", "table_name"]
RUN_SCHEMA = ("run_id string, pipeline_name string, status string, start_time timestamp_ntz, "
              "end_time timestamp_ntz, rows_processed bigint, rows_loaded bigint, error_message string, "
              "metadata string")


def empty_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MARK_SCHEMA)


def marks_from(df: DataFrame, pipeline: str, table_col: str, value_col: str, updated_at: str) -> DataFrame:
    """Marks computed by Spark: max of ``value_col`` per ``table_col`` group."""
    return df.groupBy(F.col(table_col).alias("table_name")).agg(
        F.max(value_col).alias("_v")).select(
        F.lit(pipeline).alias("pipeline_name"), "table_name",
        F.date_format("_v", "yyyy-MM-dd HH:mm:ss").alias("watermark_value"),
        F.lit(updated_at).cast("timestamp_ntz").alias("updated_at"))


def save_marks(marks: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or replace by (pipeline, table); the latest update wins."""
    return upsert(marks, new.select(*marks.columns), MARK_KEYS, order_by=["updated_at"])


def lookup_mark(marks: DataFrame, pipeline: str, table: str) -> DataFrame:
    """Zero or one row; 'not found' is the only case that yields no mark."""
    return marks.filter((F.col("pipeline_name") == pipeline) & (F.col("table_name") == table))


def mark_value(marks: DataFrame, pipeline: str, table: str) -> str | None:
    row = lookup_mark(marks, pipeline, table).select("watermark_value").first()
    return None if row is None else row[0]


class RunLog:
    """Records runs: start, end, status, row counts, attempt.

    With a ``path`` every finished run is appended to the snapshot table there as soon
    as it ends, failed ones too, with the attempt's number (one more than the run
    has in the table). Without one the rows stay in this object. ``frame()`` gives
    the rows of this object either way.

    The record given to the run takes row counts as ``counts`` (numbers) or through
    the observations ``processed`` and ``loaded``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path
        self.rows: list[tuple] = []

    @contextmanager
    def run(self, run_id: str, pipeline: str, clock=None):
        clock = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        rec = {"processed": Observation(f"processed_{run_id}"), "loaded": Observation(f"loaded_{run_id}"),
               "counts": {}, "meta": {}}
        start, failure = clock(), None
        try:
            yield rec
        except Exception as e:
            failure = "".join(traceback.format_exception_only(e)).strip()
            raise
        finally:
            rows = [rec["counts"].get(k, self._n(rec[k])) for k in ("processed", "loaded")]
            self._finish((run_id, pipeline, "failed" if failure else "success", start, clock(), *rows, failure,
                          json.dumps(rec["meta"], default=str)))

    def _finish(self, row: tuple) -> None:
        self.rows.append(row)
        while self.path:
            base = SN.current(self.spark, self.path)
            before = 0
            if base is not None:
                before = SN.read_snapshot(self.spark, self.path, base).where(F.col("run_id") == row[0]).count()
            one = self.spark.createDataFrame([(*row, before + 1)], f"{RUN_SCHEMA}, attempt int").coalesce(1)
            try:
                SN.publish(one, self.path, mode="append", base=base)
                return
            except SN.CommitConflict:  # another run ended in between: look again
                continue

    @staticmethod
    def _n(obs: Observation) -> int:
        try:
            return int(obs.get.get("rows", 0))
        except Exception:  # noqa: BLE001 - observation never attached
            return 0

    @staticmethod
    def counted(df: DataFrame, obs: Observation) -> DataFrame:
        """Attach a row counter that fills in when ``df`` is written."""
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, RUN_SCHEMA)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a persisted log; none when nothing was logged yet."""
    if SN.current(spark, path) is None:
        return spark.createDataFrame([], f"{RUN_SCHEMA}, attempt int")
    return SN.read(spark, path)


def compact_run_log(spark: SparkSession, path: str) -> None:
    """The same rows in one folder; a run that ends meanwhile makes this load fail, not
    vanish."""
    base = SN.current(spark, path)
    if base is not None:
        SN.publish(SN.read_snapshot(spark, path, base).coalesce(1), path, base=base)
