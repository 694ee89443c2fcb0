"""Daily revenue mart and the dashboard queries that read it.

Plan shape (per day):
  lineitem (5 columns) --join, its kind left to Spark and AQE--> part
      -> partial + final aggregate per order key  (one shuffle, map-side combine)
      -> join orders on the same key              (re-uses that partitioning)
      -> aggregate per day                        (tiny: one row per day)

Counting distinct orders per day would need an Expand and a second distinct
shuffle; aggregating to one row per order first turns it into a plain count.
Money is exact 64-bit fixed point (cents, 10^-4 for revenue) until the final
conversion of the few daily totals, so results do not depend on summation order
and equal the decimal formulation bit for bit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.scalar import checked_units, safe_divide, units, units_to_double
from martlake.params import MartParams


def category_column(category: str) -> str:
    return f"{category.lower()}_revenue"


def _ratio(text: str) -> tuple[int, int]:
    d = Decimal(text)
    scale = max(-d.as_tuple().exponent, 0)
    return int(d.scaleb(scale)), scale


def revenue_lines(lineitem: DataFrame, part: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    """One row per order line with exact revenue and cost as integers.

    ``revenue`` is in 10^-4 units (cents x percent), ``cost`` in
    10^-(4+r) units where r is the decimal places of the cost ratio. 64-bit
    integer arithmetic keeps every line exact and stays on Spark's fast path
    (decimals wider than 18 digits fall back to arbitrary precision).
    """
    li = lineitem.select("l_orderkey", "l_partkey", *checked_units(
        {"_price": "l_extendedprice", "_discount": "l_discount", "_quantity": "l_quantity"}, 2))
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_type", units("p_retailprice", 2).alias("_retail"))
    k, r = _ratio(params.cost_ratio)
    revenue = F.col("_price") * (F.lit(100) - F.col("_discount"))
    cost = F.lit(k) * F.col("_retail") * F.col("_quantity")
    rev_c = revenue * F.lit(10 ** r)
    margin = F.lit(100.0) * safe_divide((rev_c - cost).cast("double") / F.lit(10.0 ** (4 + r)),
                                        rev_c.cast("double") / F.lit(10.0 ** (4 + r)))
    return (li.join(p, "l_partkey")
            .select("l_orderkey", "p_type", revenue.alias("revenue"), cost.alias("cost"),
                    margin.alias("margin_pct")))


REVENUE_SCALE = 4


def order_revenue(lineitem: DataFrame, part: DataFrame, params: MartParams = MartParams()) -> DataFrame:
    """Per-order partial sums; the only lineitem-sized shuffle of the mart."""
    lines = revenue_lines(lineitem, part, params)
    cats = [F.sum(F.when(F.col("p_type") == c, F.col("revenue")).otherwise(F.lit(0).cast("bigint")))
            .alias(category_column(c)) for c in params.categories]
    return lines.groupBy("l_orderkey").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("margin_pct").alias("margin_sum"),
        F.count(F.lit(1)).alias("n_lines"),
        *cats)


def mart_revenue(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
                 params: MartParams = MartParams()) -> DataFrame:
    per_order = order_revenue(lineitem, part, params)
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"),
                      F.to_date("o_orderdate").alias("date_day"))
    joined = per_order.join(o, "l_orderkey")
    cats = [units_to_double(F.sum(category_column(c)), REVENUE_SCALE).alias(category_column(c))
            for c in params.categories]
    daily = joined.groupBy("date_day").agg(
        F.sum("revenue").alias("_rev"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("margin_sum").alias("_margin_sum"),
        F.sum("n_lines").alias("_lines"),
        *cats)
    total = units_to_double("_rev", REVENUE_SCALE)
    return daily.select(
        "date_day",
        total.alias("total_revenue"),
        "total_orders",
        safe_divide(total, F.col("total_orders")).alias("avg_order_value"),
        F.round(safe_divide(F.col("_margin_sum"), F.col("_lines")), 6).alias("avg_gross_margin_pct"),
        *[category_column(c) for c in params.categories],
    )


def mart_revenue_staged(lineitem: DataFrame, stg_orders: DataFrame, stg_products: DataFrame,
                        params: MartParams = MartParams()) -> DataFrame:
    """The mart over staged orders and products (one row per key, so an order or a
    product that was delivered twice counts once)."""
    orders = stg_orders.select(F.col("order_id").alias("o_orderkey"), F.col("created_at").alias("o_orderdate"))
    part = stg_products.select(F.col("product_id").alias("p_partkey"), F.col("category").alias("p_type"),
                               F.col("price").alias("p_retailprice"))
    return mart_revenue(lineitem, orders, part, params)


def _exact_sum(col: str):
    """Sum of doubles that came from 4-place decimals, re-summed exactly."""
    return F.sum(F.col(col).cast("decimal(38,4)")).cast("double")


def revenue_kpis(mart: DataFrame) -> DataFrame:
    """Totals and unweighted means over the days; an empty mart sums to 0."""
    return mart.agg(
        F.coalesce(_exact_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.round(F.avg("avg_order_value"), 6).alias("avg_order_value"),
        F.round(F.avg("avg_gross_margin_pct"), 6).alias("avg_gross_margin_pct"),
    )


def revenue_by_category(mart: DataFrame, suffix: str = "_revenue") -> DataFrame:
    """Sum each available ``*_revenue`` column into (category, revenue) rows."""
    cols = [c for c in mart.columns if c.endswith(suffix) and c != "total" + suffix]
    if not cols:
        return mart.sparkSession.createDataFrame([], "category string, revenue double")
    long = mart.unpivot(ids=[], values=cols, variableColumnName="name", valueColumnName="value")
    return (long.groupBy("name").agg(_exact_sum("value").alias("revenue"))
            .select(F.regexp_replace("name", suffix + "$", "").alias("category"), "revenue"))


def revenue_trend(mart: DataFrame) -> DataFrame:
    """Daily series for the trend plots, in day order."""
    return mart.select("date_day", "total_revenue", "total_orders").orderBy("date_day")
