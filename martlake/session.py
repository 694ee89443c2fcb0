"""Session helpers: one place for the settings every job relies on.

The library never builds its own cluster configuration; it only reads what the
session already has and fills in the few settings results depend on (UTC
session zone, microsecond Parquet timestamps) when they are missing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not just speed. Applied to a session when the
# caller left them at Spark's defaults.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str | None = None, app_name: str = "martlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster use the cluster's session
    and call :func:`prepare` on it instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        **RESULT_SETTINGS,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the result-affecting settings on an existing session."""
    for k, v in RESULT_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged files.

    Read from the session (the context's checkpoint dir or
    ``spark.checkpoint.dir``). When neither is set, a local-mode session (tests,
    local runs) gets a fresh private folder; a cluster session raises, because
    executors cannot reach a folder on the driver's disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context (Spark Connect)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current and sc is not None:
            sc.setCheckpointDir(current)
    if not current:
        master = sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")
        if not master.startswith("local"):
            # executors on other machines cannot see a driver-local folder
            raise RuntimeError("set spark.checkpoint.dir to shared storage (e.g. an HDFS or object-store "
                               "path) before running martlake jobs on a cluster")
        current = tempfile.mkdtemp(prefix="martlake-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
        else:
            spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "scratch", f"{label}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Input tables (one Parquet file or folder per table), read with their
    declared schema when one exists (``martlake.contracts``)."""
    from martlake.contracts import TABLE_SCHEMAS
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
