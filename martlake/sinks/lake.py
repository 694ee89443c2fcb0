"""Lake and table writers.

* Partitioned Parquet by zero-padded ``year=/month=/day=`` computed per row
  (routing a whole frame by its first row would misfile rows).
* Incremental batches go to ``batch_id=<pipeline>_<start>_<end>/`` with dynamic
  partition overwrite, so replaying the same window replaces itself.
* Full refresh, merge and SCD2 loads publish a new version of a snapshot table
  (``sinks.snapshots``): readers see all of a load or nothing of it, and a load
  never overwrites what its own plan reads. Of a partitioned table only the
  partitions present in the batch are read, merged and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.scalar import batch_stamp, date_parts
from martlake.operators.merge import upsert
from martlake.session import scratch_path
from martlake.sinks import snapshots as SN

PARTS = ["year", "month", "day"]


# Lake layers.
LAYERS = ("raw", "staging", "curated")


def lake_path(root: str, layer: str, entity: str) -> str:
    """``<root>/<layer>/<entity>``: where a table of the lake lives."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{entity}"


def with_date_partitions(df: DataFrame, date_col: str | None, default_date: str | None = None) -> DataFrame:
    src = F.col(date_col) if date_col else F.lit(default_date).cast("date")
    return df.select("*", *date_parts(src))


def write_partitioned(df: DataFrame, path: str, date_col: str | None, default_date: str | None = None,
                      mode: str = "overwrite", compression: str = "snappy",
                      metadata: dict[str, str] | None = None, replace: bool = False) -> Observation:
    """Write ``df`` under year/month/day folders; returns the row-count observation.

    ``mode="overwrite"`` replaces the date folders that ``df`` has rows for;
    with ``replace`` the whole table, so that folders without rows go too.
    With ``metadata`` (ingestion time, source, custom keys), a one-row
    ``_manifest`` record is written next to the data with the row count the
    write observed; readers skip ``_``-prefixed folders.
    """
    obs = Observation("lake_write")
    out = SN.spread(with_date_partitions(df, date_col, default_date), PARTS).observe(obs, F.count(F.lit(1)).alias("rows"))
    (out.write.mode(mode).option("compression", compression)
     .option("partitionOverwriteMode", "static" if replace else "dynamic").partitionBy(*PARTS).parquet(path))
    if metadata is not None:
        write_manifest(df.sparkSession, path, {**metadata, "row_count": str(obs.get.get("rows", 0))})
    return obs


def write_manifest(spark: SparkSession, path: str, metadata: dict[str, str]) -> None:
    """One-row JSON record of a write, stored under ``<path>/_manifest``."""
    keys = sorted(metadata)
    row = spark.createDataFrame([tuple(str(metadata[k]) for k in keys)], ", ".join(f"`{k}` string" for k in keys))
    row.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{path}/_manifest")


def read_partitioned(spark: SparkSession, path: str, data_schema: T.StructType) -> DataFrame:
    """Read back with the partition columns kept as zero-padded strings."""
    schema = T.StructType(list(data_schema.fields) + [T.StructField(p, T.StringType()) for p in PARTS])
    return spark.read.schema(schema).parquet(path)


def window_batch_id(pipeline: str, start: str, end: str) -> str:
    """``<pipeline>_<start>_<end>``: the batch of the rows after ``start`` up to ``end``.
    Two windows never give one id, whatever rows they hold."""
    return "_".join([pipeline, *("".join(c if c.isalnum() else "_" if c == " " else "" for c in t) for t in (start, end))])


def batch_bounds(df: DataFrame, mark_col: str, pipeline: str) -> DataFrame:
    """One row: the batch id from the min and max of the mark column."""
    return df.agg(F.min(mark_col).alias("_lo"), F.max(mark_col).alias("_hi"), F.count(F.lit(1)).alias("row_count")) \
        .select(F.concat_ws("_", F.lit(pipeline), batch_stamp("_lo"), batch_stamp("_hi")).alias("batch_id"),
                "row_count")


def write_incremental(df: DataFrame, base: str, mark_col: str, pipeline: str, window: tuple[str, str] | None = None) -> str:
    """Write a batch to its own ``batch_id=`` folder; a replay overwrites itself.

    The id names the ``window`` that was asked for. Without one it is taken from
    the batch's own marks; then two batches with the same bounds replace each other.
    """
    if window:
        bid = window_batch_id(pipeline, *window)
        if df.isEmpty():
            raise ValueError("empty batch: nothing to write")
    else:
        row = batch_bounds(df, mark_col, pipeline).first()
        if row["row_count"] == 0:
            raise ValueError("empty batch: nothing to write")
        if row["batch_id"] == pipeline:   # no non-null mark values to name the batch by
            raise ValueError(f"batch has no {mark_col} values; refusing a non-idempotent batch id")
        bid = row["batch_id"]
    (df.withColumn("batch_id", F.lit(bid)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(base))
    return bid


def stage(df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def full_refresh(df: DataFrame, path: str, table: str | None = None, notes: dict | None = None) -> int:
    """Publish ``df`` as the whole of the table at ``path`` (with ``table``: and the view
    of that name); returns rows written. ``df`` may read the table it replaces."""
    snap = SN.publish(df, path, notes=notes)
    if table:
        SN.register_view(df.sparkSession, table, path, snap.version)
    return snap.rows


def merge_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                     partition_cols: list[str], order_by: list[str] | None = None, notes: dict | None = None) -> int:
    """Upsert ``batch`` into the partitioned snapshot table at ``path``; returns the rows
    of the partitions written.

    Keys must not move between partitions (the partition columns are a
    function of the key; ``key_bucket`` always is). Only the partitions present
    in the batch are read, merged and written (a null partition value is a
    partition like any other); all others keep their files.
    """
    base = SN.current(spark, path)
    target = SN.read_snapshot(spark, path, base, SN.leaves_of(base, batch, partition_cols))
    merged = upsert(target, batch.select(*target.columns), keys, order_by)
    return SN.publish(merged, path, partition_cols, "partitions", notes, base).rows


BUCKET = "_key_bucket"


def key_bucket(keys: list[str], buckets: int):
    """Stable bucket of a natural key (same value on every run and engine)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def write_scd2_history(history: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """First version of an SCD2 history, partitioned by key bucket."""
    SN.publish(history.withColumn(BUCKET, key_bucket(keys, buckets)), path, [BUCKET])


def apply_scd2_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                          as_of: str, buckets: int, detect_changes: list[str] | None = None) -> int:
    """Load ``batch`` into the bucketed SCD2 history at ``path``; returns the rows of the
    buckets written.

    Only the key buckets present in the batch (at most ``buckets`` values) are
    read, merged and written; a key never changes bucket, so versions of one
    key always live together.
    """
    from martlake.operators.scd2 import apply_scd2
    base = SN.current(spark, path)
    b = batch.withColumn(BUCKET, key_bucket(keys, buckets))
    part = SN.read_snapshot(spark, path, base, SN.leaves_of(base, b, [BUCKET]))
    merged = apply_scd2(part.drop(BUCKET), b.drop(BUCKET), keys, as_of, detect_changes)
    return SN.publish(merged.withColumn(BUCKET, key_bucket(keys, buckets)), path, [BUCKET], "partitions", base=base).rows
