"""Jump consistent hashing into shards, in built-in functions only.

``jump_shard`` follows Lamping and Veach: a 64-bit linear congruential stream
seeded by the key jumps ahead to the next shard count at which the key would
move; the last jump below the shard count is the shard. There is no ring table,
and adding one shard moves only the keys whose next jump lands on it.

The stream's wrapping multiplication is written with 16- and 32-bit halves,
because a 64-bit product overflows under ANSI arithmetic.

Defined cases: a null key counts as key 0; a null text has size 8 (no bytes)
and the checksum of no bytes; repeated rows share a shard and get slots of
their own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values of the published algorithm
MULTIPLIER = 2862933555777941757
_MASK32 = (1 << 32) - 1
_MH, _ML = MULTIPLIER >> 32, MULTIPLIER & _MASK32


def _next_state(key: Column) -> Column:
    """(key * MULTIPLIER + 1) modulo 2^64 as a signed long, without overflow."""
    kl = key.bitwiseAND(F.lit(_MASK32))
    kh = F.shiftrightunsigned(key, 32)
    a, b = F.shiftrightunsigned(kl, 16), kl.bitwiseAND(F.lit(0xFFFF))
    p, q = b * F.lit(_ML), a * F.lit(_ML)  # both below 2^48
    low = p.bitwiseAND(F.lit(_MASK32)) + F.shiftleft(q.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    cross = (kl * F.lit(_MH)).bitwiseAND(F.lit(_MASK32))
    top = F.shiftleft((F.shiftrightunsigned(kh, 16) * F.lit(_ML)).bitwiseAND(F.lit(0xFFFF)), 16) \
        + (kh.bitwiseAND(F.lit(0xFFFF)) * F.lit(_ML)).bitwiseAND(F.lit(_MASK32))
    high = F.shiftrightunsigned(p, 32) + F.shiftrightunsigned(q, 16) + F.shiftrightunsigned(low, 32) + cross + top
    return F.shiftleft(high.bitwiseAND(F.lit(_MASK32)), 32).bitwiseOR(low.bitwiseAND(F.lit(_MASK32)))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long key. Every jump moves at least one shard on,
    so ``shards`` steps always reach the end; finished keys stand still."""
    start = F.struct(F.coalesce(key.cast("long"), F.lit(0).cast("long")).alias("key"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(acc: Column, _: Column) -> Column:
        nxt = _next_state(acc["key"])
        jump = F.floor((acc["j"] + 1) * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(nxt, 33) + 1).cast("double")))
        moved = F.struct(nxt.alias("key"), acc["j"].alias("b"), jump.cast("long").alias("j"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda acc: acc["b"].cast("int"))


def shard_rows(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", lanes: int = 64) -> DataFrame:
    """Place every row: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    ``size`` is the text's UTF-8 bytes plus 8. ``grown_shard`` is the shard with
    one shard more. ``slot`` numbers a shard's rows from 0 without gaps: rows
    are numbered inside (shard, lane), and a table of at most
    ``shards * lanes`` counts gives each lane its first slot. Raise ``lanes``
    with the data, so that a lane stays a task's work.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.col(f"`{id_col}`").cast("long")
    rows = df.select(
        key.alias("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).withColumn("shard", jump_shard(F.col("doc_id"), shards)) \
     .withColumn("grown_shard", jump_shard(F.col("doc_id"), shards + 1)) \
     .withColumn("lane", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(lanes)).cast("int"))
    ids = df.select(key.alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"))
    counts = ids.select(jump_shard(F.col("doc_id"), shards).alias("shard"),
                        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(lanes)).cast("int").alias("lane")) \
        .groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("shard", "lane").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("nth", F.row_number().over(inside) - 1) \
        .join(F.broadcast(first), ["shard", "lane"]) \
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("first_slot") + F.col("nth")).cast("long").alias("slot"), "grown_shard")
