"""Staging models: typed, trimmed, one row per key (the latest load wins).

Raw tables accumulate every load, including replays; staging keeps the most
recent version of each key and carries ``_ingestion_timestamp`` on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.scalar import money
from martlake.operators.dedup import latest_by_key
from martlake.params import MartParams

LOAD_TS = "_ingestion_timestamp"


def with_load_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(LOAD_TS, F.lit(ts).cast("timestamp_ntz"))


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    typed = raw_orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.trim("o_orderstatus").alias("status"),
        money("o_totalprice").cast("double").alias("amount"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.trim("o_orderpriority").alias("priority"),
        F.col(LOAD_TS))
    return latest_by_key(typed, ["order_id"], [LOAD_TS])


def stg_products(raw_parts: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    price = money("p_retailprice")
    typed = raw_parts.select(
        F.col("p_partkey").alias("product_id"),
        F.trim("p_name").alias("name"),
        F.trim("p_type").alias("category"),
        F.trim("p_brand").alias("brand"),
        price.cast("double").alias("price"),
        (F.lit(params.cost_ratio).cast("decimal(2,1)") * price).cast("double").alias("cost"),
        F.col(LOAD_TS))
    return latest_by_key(typed, ["product_id"], [LOAD_TS])


def stg_customers(raw_customers: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]) \
        .select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    typed = raw_customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.trim("c_name").alias("full_name"),
        F.upper(F.trim("c_mktsegment")).alias("segment"),
        F.col("c_nationkey"),
        money("c_acctbal").cast("double").alias("account_balance"),
        F.col(LOAD_TS))
    latest = latest_by_key(typed, ["customer_id"], [LOAD_TS])
    return (latest.join(geo, latest["c_nationkey"] == geo["n_nationkey"], "left")
            .select("customer_id", "full_name", "segment", "country", "region", "account_balance", LOAD_TS))
