"""Customer analytics mart and the dashboard queries over it.

Orders are reduced to one row per customer first (partial aggregation, so a
customer with a huge share of the orders costs one row per task), then joined
to the customer table on its unique key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.params import MartParams
from martlake.functions.scalar import units, units_to_double


def order_history(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(units("o_totalprice", 2)).alias("_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.min(F.to_date("o_orderdate")).alias("first_order"),
        F.max(F.to_date("o_orderdate")).alias("last_order"))


def mart_customer_analytics(customer: DataFrame, orders: DataFrame,
                            params: MartParams = MartParams()) -> DataFrame:
    hist = order_history(orders)
    c = customer.select("c_custkey", "c_name")
    j = c.join(hist, "c_custkey", "left")
    as_of = F.to_date(F.lit(params.as_of))
    revenue = F.coalesce(units_to_double("_revenue", 2), F.lit(0.0))
    recency = F.datediff(as_of, F.col("last_order"))
    years = F.greatest(F.datediff("last_order", "first_order").cast("double") / F.lit(365.25), F.lit(1.0))
    engagement = (F.when(F.col("last_order").isNull(), "Never")
                  .when(recency <= params.active_days, "Active")
                  .when(recency <= params.at_risk_days, "At Risk")
                  .otherwise("Churned"))
    segment = (F.when(revenue >= params.high_value_revenue, "High")
               .when(revenue >= params.medium_value_revenue, "Medium")
               .otherwise("Low"))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_full_name"),
        segment.alias("customer_segment"),
        engagement.alias("engagement_status"),
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        revenue.alias("lifetime_revenue"),
        recency.alias("recency_days"),
        F.when(F.col("last_order").isNull(), F.lit(0.0))
        .otherwise(revenue / years).alias("clv_score"))


def customer_kpis(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("engagement_status") == "Active").alias("active_customers"),
        F.round(F.avg("lifetime_revenue"), 6).alias("avg_lifetime_revenue"),
        F.round(F.avg("total_orders"), 6).alias("avg_orders"))


def value_counts(mart: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first; nulls are excluded."""
    return (mart.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), column))


def top_customers(mart: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` by lifetime revenue; ties by customer key, null revenue last.
    Planned as a bounded top-k (TakeOrderedAndProject), not a full sort."""
    return (mart.orderBy(F.desc_nulls_last("lifetime_revenue"), F.asc("customer_id")).limit(n)
            .select("customer_full_name", "customer_segment", "total_orders", "lifetime_revenue", "clv_score"))
