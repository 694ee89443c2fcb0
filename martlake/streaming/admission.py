"""Batches of N rows or T seconds over a landing folder of Parquet files.

Files are of any size, so batches can't be cut by files. Every landed row gets a
number: files are entered in a ledger in order of arrival with the sum of the rows
before them (one row a file), and a row's number is that sum plus its position in
its file (``_metadata.row_index``). Batches are ranges of numbers. Each is written
as one file, which a file stream takes one at a time
(``maxFilesPerTrigger = 1``).

The ledger is a snapshot table, so a file is entered once; which rows a batch holds
follows from the ledger alone. A batch that exists already isn't written again, so
an admission that died half way is simply repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.sinks import snapshots as SN

LEDGER = "file string, arrived_ms bigint, first bigint, rows bigint"
TASK_ROWS = 50_000  # rows that a task cuts into batches, once every core has a task


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(file, arrived_ms) of the landing folder's Parquet files (names only, no data)."""
    fs, top = SN._at(spark, landing)
    found = [(s.getPath().toString(), s.getModificationTime()) for s in (fs.listStatus(top) if fs.exists(top) else [])
             if s.getPath().getName().endswith(".parquet") and not s.getPath().getName().startswith(("_", "."))]
    return spark.createDataFrame(found, "file string, arrived_ms bigint")


def enter_files(spark: SparkSession, landing: str, ledger: str, schema: T.StructType) -> DataFrame:
    """Enter files that the ledger lacks, in order of arrival; returns the ledger."""
    base = SN.current(spark, ledger)
    known = SN.read_snapshot(spark, ledger, base) if base else spark.createDataFrame([], LEDGER)
    new = landed_files(spark, landing).join(known.select("file"), "file", "left_anti").collect()  # names
    if new:
        counts = spark.read.schema(schema).parquet(*[r.file for r in new]) \
            .groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
        before = known.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        order = Window.orderBy("arrived_ms", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
        listed = spark.createDataFrame(new, "file string, arrived_ms bigint").withColumn("name", F.regexp_extract("file", "[^/]+$", 0))
        rows = listed.join(counts, "name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        added = rows.withColumn("first", F.lit(before) + F.coalesce(F.sum("rows").over(order), F.lit(0))) \
            .select("file", "arrived_ms", F.col("first").cast("bigint").alias("first"), "rows")
        SN.publish(added.coalesce(1), ledger, mode="append", base=base)
    return SN.read(spark, ledger) if new or base else known


def admit(spark: SparkSession, landing: str, admitted: str, schema: T.StructType, rows: int,
          wait_s: float, now_ms: int) -> int:
    """Write the batches that are due: all of ``rows`` rows, and a shorter one when its
    first row has waited ``wait_s`` seconds at ``now_ms``. Returns their number."""
    if rows < 1:
        raise ValueError("a batch needs at least one row")
    ledger = enter_files(spark, landing, f"{admitted}/ledger", schema)
    state = SN.current(spark, f"{admitted}/cut")
    first, batch = (state.notes["next_row"], state.notes["next_batch"]) if state else (0, 0)
    waiting = ledger.where(F.col("first") + F.col("rows") > first)
    tail = waiting.agg(F.max(F.col("first") + F.col("rows")).alias("end")).first()["end"]
    if tail is None:
        return 0
    number, rest = divmod(tail - first, rows)
    if rest:
        start = first + number * rows
        oldest = waiting.where((F.col("first") <= start) & (F.col("first") + F.col("rows") > start)).agg(F.min("arrived_ms")).first()[0]
        if now_ms - oldest >= wait_s * 1000:
            number += 1
    if not number:
        return 0
    end = min(tail, first + number * rows)
    # what a died admission of this state has left; batches before it are all there
    there = {int(n.split("=")[1]) for n, folder in SN.listing(spark, f"{admitted}/batches") if folder and n.startswith("batch=")}
    there = sorted(b for b in there if b >= batch)
    files = [r.file for r in waiting.where(F.col("first") < end).select("file").collect()]
    data = spark.read.schema(schema).parquet(*files).select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_index"))
    starts = F.broadcast(waiting.select(F.regexp_extract("file", "[^/]+$", 0).alias("_name"), F.col("first").alias("_first")))  # one row a file
    numbered = data.join(starts, "_name").withColumn("_row", F.col("_first") + F.col("_index")) \
        .where((F.col("_row") >= first) & (F.col("_row") < end)) \
        .withColumn("batch", (F.lit(batch) + F.floor((F.col("_row") - first) / rows)).cast("bigint"))
    if there:
        numbered = numbered.join(F.broadcast(spark.createDataFrame([(b,) for b in there], "batch bigint")), "batch", "left_anti")
    # a batch is one task's, a task has many: batches of few rows would be as many tasks
    tasks = min(number, max(spark.sparkContext.defaultParallelism, -(-number // max(1, TASK_ROWS // rows))))
    numbered.drop("_name", "_index", "_first").repartition(tasks, "batch").sortWithinPartitions("batch", "_row").drop("_row") \
        .write.mode("append").partitionBy("batch").parquet(f"{admitted}/batches")
    SN.note(spark, f"{admitted}/cut", {"next_row": end, "next_batch": batch + number}, state)
    return number


def batch_stream(spark: SparkSession, admitted: str, schema: T.StructType, batches_per_trigger: int = 1) -> DataFrame:
    """Admitted batches, whole (a file each) and with their number as ``batch``: one at
    each trigger, or up to ``batches_per_trigger``. A trigger has a fixed cost, whatever
    it holds, so a backlog of many small batches is read by many at once."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.readStream.schema(full).option("maxFilesPerTrigger", batches_per_trigger) \
        .option("basePath", f"{admitted}/batches").parquet(f"{admitted}/batches")


def check_batches(delivered: DataFrame, rows: int) -> int:
    """Raise unless the delivered batches are numbered from 0 without gaps and have ``rows``
    rows each, all but the last, which may have fewer. Returns their number."""
    sizes = delivered.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.count(F.lit(1)).alias("batches"), F.min("batch").alias("low"), F.max("batch").alias("high"),
                      F.max("n").alias("most"), F.count_if(F.col("n") != rows).alias("other"),
                      F.max_by(F.col("n"), "batch").alias("last")).first()
    if found.batches and (found.low != 0 or found.high != found.batches - 1 or found.most > rows
                          or found.other != int(found.last != rows)):
        raise RuntimeError(f"batches of other sizes: {found.asDict()}")
    return found.batches
