"""Marts and dashboard queries over the driver tables."""

from __future__ import annotations

from martlake.params import MartParams
from martlake.plans import revenue as rev
from martlake.registry import register
from martlake.session import prepare, read_table

P = MartParams()


def _t(spark, sf_dir, name):
    prepare(spark)
    return read_table(spark, sf_dir, name)


def _cat_sql(alias: str = "revenue") -> str:
    return ",\n       ".join(
        f"CAST(SUM(CASE WHEN p_type = '{c}' THEN {alias} ELSE 0 END) AS DOUBLE) AS {rev.category_column(c)}"
        for c in P.categories)


LINES_SQL = f"""
  SELECT l.l_orderkey, p.p_type,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS revenue,
         CAST({P.cost_ratio} AS DECIMAL(2,1)) * CAST(p.p_retailprice AS DECIMAL(12,2))
           * CAST(l.l_quantity AS DECIMAL(12,2)) AS cost
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""

MART_REVENUE_SQL = f"""
WITH lines AS ({LINES_SQL}),
m AS (
  SELECT *, 100.0 * CASE WHEN revenue = 0 OR revenue IS NULL THEN 0
                         ELSE CAST(revenue - cost AS DOUBLE) / CAST(revenue AS DOUBLE) END AS margin_pct
  FROM lines)
SELECT CAST(o.o_orderdate AS DATE) AS date_day,
       CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT o.o_orderkey) AS total_orders,
       CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT o.o_orderkey) AS avg_order_value,
       ROUND(AVG(margin_pct), 6) AS avg_gross_margin_pct,
       {_cat_sql()}
FROM m JOIN orders o ON m.l_orderkey = o.o_orderkey
GROUP BY 1
ORDER BY 1
"""


def build_mart_revenue(spark, sf_dir):
    return rev.mart_revenue(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"),
                            _t(spark, sf_dir, "part"), P)


@register("mart_revenue", MART_REVENUE_SQL)
def q_mart_revenue(spark, sf_dir):
    return build_mart_revenue(spark, sf_dir).orderBy("date_day")


@register("revenue_trend", f"SELECT date_day, total_revenue, total_orders FROM ({MART_REVENUE_SQL}) ORDER BY date_day")
def q_revenue_trend(spark, sf_dir):
    return rev.revenue_trend(build_mart_revenue(spark, sf_dir))


@register("revenue_kpis", f"""
SELECT coalesce(CAST(sum(CAST(total_revenue AS DECIMAL(38,4))) AS DOUBLE), 0.0) AS total_revenue,
       CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders,
       round(avg(avg_order_value), 6) AS avg_order_value,
       round(avg(avg_gross_margin_pct), 6) AS avg_gross_margin_pct
FROM ({MART_REVENUE_SQL})""")
def q_revenue_kpis(spark, sf_dir):
    return rev.revenue_kpis(build_mart_revenue(spark, sf_dir))


@register("revenue_by_category", "\nUNION ALL\n".join(
    f"SELECT '{c.lower()}' AS category, CAST(sum(CAST({rev.category_column(c)} AS DECIMAL(38,4))) AS DOUBLE) AS revenue "
    f"FROM ({MART_REVENUE_SQL})" for c in P.categories))
def q_revenue_by_category(spark, sf_dir):
    return rev.revenue_by_category(build_mart_revenue(spark, sf_dir))


# ------------------------------------------------------------------ staging

from martlake.plans import customers as cust  # noqa: E402
from martlake.plans import dashboard as dash  # noqa: E402
from martlake.plans import derived as D  # noqa: E402
from martlake.plans import staging as stg  # noqa: E402

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def raw_orders(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return stg.with_load_time(orders, T0).unionByName(stg.with_load_time(D.upsert_batch(orders), T1))


RAW_ORDERS_SQL = f"""(SELECT *, TIMESTAMP '{T0}' AS _ingestion_timestamp FROM orders
  UNION ALL SELECT *, TIMESTAMP '{T1}' AS _ingestion_timestamp FROM {D.UPSERT_BATCH_SQL})"""

STG_ORDERS_SQL = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, trim(o_orderstatus) AS status,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, o_orderdate AS created_at,
       trim(o_orderpriority) AS priority, _ingestion_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _ingestion_timestamp DESC) AS rn
      FROM {RAW_ORDERS_SQL}) WHERE rn = 1"""

STG_PRODUCTS_SQL = f"""
SELECT p_partkey AS product_id, trim(p_name) AS name, trim(p_type) AS category, trim(p_brand) AS brand,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
       CAST(CAST({P.cost_ratio} AS DECIMAL(2,1)) * CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS cost,
       TIMESTAMP '{T0}' AS _ingestion_timestamp
FROM part"""

STG_CUSTOMERS_SQL = f"""
SELECT c_custkey AS customer_id, trim(c_name) AS full_name, upper(trim(c_mktsegment)) AS segment,
       n_name AS country, r_name AS region, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS account_balance,
       TIMESTAMP '{T0}' AS _ingestion_timestamp
FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey"""


@register("stg_orders", STG_ORDERS_SQL)
def q_stg_orders(spark, sf_dir):
    return stg.stg_orders(raw_orders(spark, sf_dir))


@register("stg_products", STG_PRODUCTS_SQL)
def q_stg_products(spark, sf_dir):
    return stg.stg_products(stg.with_load_time(_t(spark, sf_dir, "part"), T0), P)


def build_stg_customers(spark, sf_dir):
    return stg.stg_customers(stg.with_load_time(_t(spark, sf_dir, "customer"), T0),
                             _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))


@register("stg_customers", STG_CUSTOMERS_SQL)
def q_stg_customers(spark, sf_dir):
    return build_stg_customers(spark, sf_dir)


# ------------------------------------------------------------------ customer mart

AS_OF_DATE = P.as_of[:10]
_REV = "coalesce(CAST(h.rev AS DOUBLE), 0.0)"
_REC = f"CAST(date_diff('day', h.l, DATE '{AS_OF_DATE}') AS INTEGER)"
MART_CUSTOMER_SQL = f"""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_full_name,
       CASE WHEN {_REV} >= {P.high_value_revenue} THEN 'High'
            WHEN {_REV} >= {P.medium_value_revenue} THEN 'Medium' ELSE 'Low' END AS customer_segment,
       CASE WHEN h.l IS NULL THEN 'Never' WHEN {_REC} <= {P.active_days} THEN 'Active'
            WHEN {_REC} <= {P.at_risk_days} THEN 'At Risk' ELSE 'Churned' END AS engagement_status,
       CAST(coalesce(h.n, 0) AS BIGINT) AS total_orders,
       {_REV} AS lifetime_revenue,
       {_REC} AS recency_days,
       CASE WHEN h.l IS NULL THEN 0.0
            ELSE {_REV} / greatest(CAST(date_diff('day', h.f, h.l) AS DOUBLE) / CAST(365.25 AS DOUBLE), 1.0) END AS clv_score
FROM customer c LEFT JOIN (
  SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS rev, count(*) AS n,
         min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS l
  FROM orders GROUP BY o_custkey) h ON c.c_custkey = h.o_custkey"""


def build_customer_mart(spark, sf_dir):
    return cust.mart_customer_analytics(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders"), P)


@register("mart_customer_analytics", MART_CUSTOMER_SQL)
def q_mart_customer_analytics(spark, sf_dir):
    return build_customer_mart(spark, sf_dir)


@register("customer_kpis", f"""
SELECT count(*) AS total_customers, CAST(count_if(engagement_status = 'Active') AS BIGINT) AS active_customers,
       round(avg(lifetime_revenue), 6) AS avg_lifetime_revenue, round(avg(total_orders), 6) AS avg_orders
FROM ({MART_CUSTOMER_SQL})""")
def q_customer_kpis(spark, sf_dir):
    return cust.customer_kpis(build_customer_mart(spark, sf_dir))


def _counts_sql(col):
    return (f"SELECT {col}, count(*) AS count FROM ({MART_CUSTOMER_SQL}) WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY count DESC, {col}")


@register("customer_segment_counts", _counts_sql("customer_segment"))
def q_customer_segment_counts(spark, sf_dir):
    return cust.value_counts(build_customer_mart(spark, sf_dir), "customer_segment")


@register("engagement_counts", _counts_sql("engagement_status"))
def q_engagement_counts(spark, sf_dir):
    return cust.value_counts(build_customer_mart(spark, sf_dir), "engagement_status")


@register("top_customers", f"""
SELECT customer_full_name, customer_segment, total_orders, lifetime_revenue, clv_score
FROM ({MART_CUSTOMER_SQL}) ORDER BY lifetime_revenue DESC NULLS LAST, customer_id LIMIT 10""")
def q_top_customers(spark, sf_dir):
    return cust.top_customers(build_customer_mart(spark, sf_dir))


# ------------------------------------------------------------------ pipeline health

RUNS_SQL = """(SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS pipeline_name,
   CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
   ts AS start_time, ts + INTERVAL 60 SECOND AS end_time, user_id AS rows_processed,
   CASE WHEN event_type = 'error' THEN 0 ELSE user_id END AS rows_loaded,
   CASE WHEN event_type = 'error' THEN 'error event ' || CAST(event_id AS VARCHAR) END AS error_message
 FROM events)"""

LATEST_RUNS_SQL = f"""
SELECT pipeline_name, status, start_time, end_time, rows_processed, rows_loaded, error_message
FROM {RUNS_SQL} ORDER BY start_time DESC NULLS FIRST, run_id DESC LIMIT 20"""


def build_latest_runs(spark, sf_dir):
    return dash.latest_runs(dash.runs_from_events(_t(spark, sf_dir, "events")))


@register("latest_runs", LATEST_RUNS_SQL)
def q_latest_runs(spark, sf_dir):
    return build_latest_runs(spark, sf_dir)


@register("run_status_summary", f"""
SELECT count(*) AS total_runs, CAST(count_if(status = 'success') AS BIGINT) AS successful_runs,
       CAST(count_if(status = 'failed') AS BIGINT) AS failed_runs FROM ({LATEST_RUNS_SQL})""")
def q_run_status_summary(spark, sf_dir):
    return dash.run_status_summary(build_latest_runs(spark, sf_dir))


@register("table_row_counts", f"""
SELECT 'raw.orders' AS table_name, count(*) AS row_count FROM {RAW_ORDERS_SQL}
UNION ALL SELECT 'raw.products', count(*) FROM part
UNION ALL SELECT 'raw.customers', count(*) FROM customer
UNION ALL SELECT 'staging.stg_orders', count(*) FROM ({STG_ORDERS_SQL})
UNION ALL SELECT 'staging.stg_products', count(*) FROM ({STG_PRODUCTS_SQL})
UNION ALL SELECT 'staging.stg_customers', count(*) FROM ({STG_CUSTOMERS_SQL})""")
def q_table_row_counts(spark, sf_dir):
    raw_o = raw_orders(spark, sf_dir)
    return dash.table_row_counts({
        "raw.orders": raw_o,
        "raw.products": _t(spark, sf_dir, "part"),
        "raw.customers": _t(spark, sf_dir, "customer"),
        "staging.stg_orders": stg.stg_orders(raw_o),
        "staging.stg_products": stg.stg_products(stg.with_load_time(_t(spark, sf_dir, "part"), T0), P),
        "staging.stg_customers": build_stg_customers(spark, sf_dir),
    })
