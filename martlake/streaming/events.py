"""Event ingestion with Structured Streaming.

* Micro-batching: ``readStream`` over a landing folder with a per-trigger file
  cap, run with a processing-time trigger or ``availableNow``; batches of N rows or
  T seconds come from ``streaming.admission``.
* Checkpointed reads: a restart reads only what was not committed; with the sink of
  ``streaming.commits`` every row is delivered exactly once, before any dedup.
* Duplicate delivery: ``dropDuplicatesWithinWatermark`` on the event id keeps
  state bounded by the watermark.
* Late events: what comes behind the watermark is dropped by the stream, repeated
  or not. ``keep_late`` goes through newly landed files once more and keeps events
  that were never delivered, found by an anti join on (day, id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlake.operators.dedup import latest_by_key
from martlake.sinks import snapshots as SN
from martlake.streaming.admission import landed_files


def event_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def dedup_within_watermark(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop repeated deliveries of the same event id while its state lives.

    Watermarks need a zoned timestamp; a naive (NTZ) event time is read as UTC
    into a helper column that is dropped again afterwards."""
    if dict(stream.dtypes)[event_time] == "timestamp":
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return (stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key])
            .drop("_event_time"))


def write_files(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True,
                processing_time: str | None = None, fmt: str = "parquet", partition_by: list[str] | None = None) -> StreamingQuery:
    """Exactly-once file sink (commit log under ``sink/_spark_metadata``)."""
    w = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "60 seconds")
    return w.start(sink)


def run_to_completion(stream: DataFrame, sink: str, checkpoint: str, timeout_s: int | None = None,
                      partition_by: list[str] | None = None) -> dict:
    """Drain everything available, then stop. Returns batch count and input rows.
    Without ``timeout_s`` a backlog may take as long as it needs."""
    return drain(write_files(stream, sink, checkpoint, available_now=True, partition_by=partition_by), timeout_s)


def drain(q: StreamingQuery, timeout_s: int | None = None) -> dict:
    """Wait for the end of an ``availableNow`` query; its batch count and input rows."""
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise q.exception()
    progress = q.recentProgress
    sizes = [p.get("numInputRows", 0) for p in progress if p.get("numInputRows", 0) > 0]
    return {"batches": len(sizes), "rows": sum(sizes), "sizes": sizes}


def read_sink(spark: SparkSession, sink: str, key: str | None = None,
              order_by: list[str] | None = None, drop: list[str] | None = None) -> DataFrame:
    """Committed sink files, without the columns ``drop``; with ``key``, one row per key
    (late duplicates removed)."""
    df = spark.read.parquet(sink).drop(*(drop or []))
    if key:
        df = latest_by_key(df, [key], order_by or [c for c in df.columns if c != key][:1])
    return df


DAY = "_day"


def keep_late(spark: SparkSession, landing: str, on_time: str, late: str, schema, key: str, event_time: str) -> int:
    """Add to the snapshot table ``late`` the events of newly landed files whose id was
    neither delivered on time (the sink, partitioned by ``DAY``) nor kept as late
    before; returns their number.

    A repeated delivery has its first one's event time, so both are of one day, and
    only the days of the new files are looked at. The table's commit also names the
    files gone through, so a pass that dies is repeated whole.
    """
    base = SN.current(spark, late)
    done = SN.current(spark, f"{late}/files")
    seen = SN.read_snapshot(spark, f"{late}/files", done) if done else spark.createDataFrame([], "file string")
    files = landed_files(spark, landing).join(seen, "file", "left_anti").select("file")
    names = [r.file for r in files.collect()]
    if not names:
        return 0
    day = F.to_date(F.col(event_time)).cast("string").alias(DAY)
    new = spark.read.schema(schema).parquet(*names).select("*", day)
    days = new.select(DAY).distinct()
    delivered = spark.read.parquet(on_time).select(F.col(DAY).cast("string").alias(DAY), key)
    if base is not None:
        delivered = delivered.unionByName(SN.read_snapshot(spark, late, base).select(DAY, key))
    delivered = delivered.join(days, DAY, "left_semi")
    missed = latest_by_key(new.join(delivered, [DAY, key], "left_anti"), [key], [event_time])
    snap = SN.publish(missed, late, mode="append", base=base)
    SN.publish(spark.createDataFrame([(n,) for n in names], "file string").coalesce(1), f"{late}/files", mode="append", base=done)
    return snap.rows


def read_events(spark: SparkSession, on_time: str, late: str, key: str) -> DataFrame:
    """Events delivered on time and late ones, each once. An event that a running stream
    has delivered after a late pass had found it missing counts as on time."""
    first = spark.read.parquet(on_time)
    snap = SN.current(spark, late)
    if snap is None:
        return first.drop(DAY)
    behind = SN.read_snapshot(spark, late, snap)
    behind = behind.join(first.select(F.col(DAY).cast("string").alias(DAY), key), [DAY, key], "left_anti")
    behind = behind.dropDuplicates([key])  # a pass that died before it noted its files
    return first.drop(DAY).unionByName(behind.drop(DAY).select(first.drop(DAY).columns))
