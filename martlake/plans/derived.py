"""Derived inputs used by the check and load queries.

The driver tables have no nulls, NaNs, duplicates or orphan keys, so the
defect paths are exercised on inputs derived from them by fixed rules. Each
rule is also written as SQL so the oracle builds the identical input. All of
them read whole tables; their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed rules (the oracle SQL below states the same ones).
NULL_EVERY = 7        # o_custkey null where o_orderkey % 7 = 0
NAN_EVERY = 11        # o_totalprice NaN where o_orderkey % 11 = 0
DUP_EVERY = 13        # orders rows repeated where o_orderkey % 13 = 0
PARENT_GAP = 10       # parent customer without c_custkey % 10 = 0
TARGET_EVERY = 2      # upsert target: o_orderkey % 2 = 0
BATCH_EVERY = 3       # upsert batch: o_orderkey % 3 = 0, amount x 1.1
SCD_EVERY = 5         # SCD2 batch: c_custkey % 5 = 0 with a new segment


def orders_with_defects(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    base = orders.select(
        "o_orderkey",
        F.when(k % NULL_EVERY == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(k % NAN_EVERY == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    return base.unionByName(base.filter(k % DUP_EVERY == 0))


ORDERS_WITH_DEFECTS_SQL = f"""(
  WITH b AS (
    SELECT o_orderkey,
           CASE WHEN o_orderkey % {NULL_EVERY} = 0 THEN NULL ELSE o_custkey END AS o_custkey,
           o_orderstatus,
           CASE WHEN o_orderkey % {NAN_EVERY} = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders)
  SELECT * FROM b UNION ALL SELECT * FROM b WHERE o_orderkey % {DUP_EVERY} = 0)"""


def customers_with_gaps(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("c_custkey") % PARENT_GAP != 0)


CUSTOMERS_WITH_GAPS_SQL = f"(SELECT * FROM customer WHERE c_custkey % {PARENT_GAP} <> 0)"


def upsert_target(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderkey") % TARGET_EVERY == 0)


def upsert_batch(orders: DataFrame) -> DataFrame:
    """Changed amounts: x 1.1 on exact decimals, back to double."""
    return (orders.filter(F.col("o_orderkey") % BATCH_EVERY == 0)
            .withColumn("o_totalprice",
                        raised_amount(F.col("o_totalprice"))))


def raised_amount(col):
    """amount x 1.1 on exact decimals, rounded half-up to cents, as double."""
    return F.round(col.cast("decimal(12,2)") * F.lit("1.1").cast("decimal(2,1)"), 2).cast("double")


UPSERT_TARGET_SQL = f"(SELECT * FROM orders WHERE o_orderkey % {TARGET_EVERY} = 0)"
UPSERT_BATCH_SQL = f"""(SELECT o_orderkey, o_custkey, o_orderstatus,
   CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(1.1 AS DECIMAL(2,1)), 2) AS DOUBLE) AS o_totalprice,
   o_orderdate, o_orderpriority
 FROM orders WHERE o_orderkey % {BATCH_EVERY} = 0)"""
