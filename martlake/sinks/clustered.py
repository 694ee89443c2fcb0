"""Tables clustered by key, with a zone map: the smallest and the largest key of every
leaf stand in the commit, so a load knows from it which leaves it can touch.

An upsert keeps every leaf whose zone doesn't meet the batch's keys without opening
it. Of the others it reads the key column alone and rewrites those that really hold
one of the batch's keys; keys that the table lacks become leaves of their own. All
other leaves are named again by the new version, file by file as they are.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators.merge import upsert
from martlake.session import scratch_path
from martlake.sinks import snapshots as SN

ZONE = "_zone"
ROWS_PER_LEAF = 1_000_000


def _clustered(df: DataFrame, key: str, rows_per_leaf: int, label: str) -> DataFrame:
    """``df`` in ranges of the key, numbered by ``ZONE`` (a text that no other load uses)."""
    spark = df.sparkSession
    leaves = max(1, -(-df.count() // rows_per_leaf))
    path = scratch_path(spark, "clustered")
    name = F.concat(F.lit(f"{label}-"), F.spark_partition_id().cast("string"))
    df.repartitionByRange(leaves, F.col(key)).withColumn(ZONE, name).write.parquet(path)  # the ranges are fixed from here on
    return spark.read.parquet(path)


def _zones(df: DataFrame, key: str) -> dict[str, list]:
    """Zone of each leaf of ``df``: smallest and largest key as text, whether a key is null."""
    rows = df.groupBy(ZONE).agg(F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"),
                                (F.count(F.lit(1)) > F.count(key)).alias("nulls")).collect()  # one row a leaf
    return {r[ZONE]: [r["low"], r["high"], r["nulls"]] for r in rows}


def publish_clustered(df: DataFrame, path: str, key: str, rows_per_leaf: int = ROWS_PER_LEAF) -> SN.Snapshot:
    """Replace the table at ``path`` by ``df``, clustered by ``key``."""
    spark = df.sparkSession
    version = (SN.versions(spark, path) or [0])[0] + 1
    rows = _clustered(df, key, rows_per_leaf, f"v{version}")
    return SN.publish(rows, path, [ZONE], notes={"key": key, "rows_per_leaf": rows_per_leaf, "zones": _zones(rows, key)})


def read_clustered(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return SN.read(spark, path, version).drop(ZONE)


def meeting_zones(keys: DataFrame, key: str, zones: dict[str, list]) -> set[str]:
    """Leaves whose zone meets one of ``keys`` (distinct). All bounds cut the keys' order into
    intervals; each key's interval is found by binary search in the tasks, and only the
    intervals that were hit (at most two for each leaf) reach the driver."""
    if not zones:
        return set()
    spark, kind = keys.sparkSession, keys.schema[key].dataType.simpleString()
    listed = spark.createDataFrame([(n, *z) for n, z in zones.items()], f"{ZONE} string, low string, high string, nulls boolean")
    typed = listed.select(ZONE, F.col("low").cast(kind).alias("low"), F.col("high").cast(kind).alias("high"), "nulls")
    bounds = sorted({b for r in typed.collect() for b in (r["low"], r["high"]) if b is not None})
    def places(it):  # 2i + 1: on bound i; 2i: between the bounds i - 1 and i
        for batch in it:
            found = set()
            for k in batch.column(0).to_pylist():
                i = bisect_left(bounds, k)
                found.add(2 * i + (i < len(bounds) and bounds[i] == k))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["p"])

    hit = sorted(r["p"] for r in keys.where(F.col(key).isNotNull()).select(key).mapInArrow(places, "p long").distinct().collect())
    met = set()
    for r in typed.where("low is not null").collect():
        low, high = (2 * bisect_left(bounds, r[c]) + 1 for c in ("low", "high"))
        i = bisect_left(hit, low)
        if i < len(hit) and hit[i] <= high:
            met.add(r[ZONE])
    if keys.where(F.col(key).isNull()).take(1):
        met |= {n for n, z in zones.items() if z[2]}
    return met


def upsert_clustered(batch: DataFrame, path: str, order_by: list[str] | None = None) -> SN.Snapshot:
    """Upsert ``batch`` into the clustered table at ``path``; see the module's text for
    what is read and what is written."""
    spark = batch.sparkSession
    base = SN.current(spark, path)
    key, zones = base.notes["key"], base.notes["zones"]
    keys = batch.select(F.col(key).alias("_batch_key")).distinct()
    near = meeting_zones(keys.select(F.col("_batch_key").alias(key)), key, zones)
    names = {SN.leaf_values(x)[0]: SN.leaf_name(x) for x in base.leaves}
    probe = SN.read_snapshot(spark, path, base, {names[n] for n in near}).select(key, ZONE)
    held = {r[ZONE] for r in probe.join(keys, F.col(key).eqNullSafe(F.col("_batch_key")), "left_semi").select(ZONE).distinct().collect()}
    old = SN.read_snapshot(spark, path, base, {names[n] for n in held}).drop(ZONE)
    rows = _clustered(upsert(old, batch.select(*old.columns), [key], order_by), key, base.notes["rows_per_leaf"], f"v{base.version + 1}")
    kept = tuple(x for x in base.leaves if SN.leaf_values(x)[0] not in held)
    after = {n: z for n, z in zones.items() if n not in held} | _zones(rows, key)
    pending = SN.prepare(rows, path, [ZONE], "append", {"zones": after}, SN.replace(base, leaves=kept))
    return SN.commit(spark, pending)
