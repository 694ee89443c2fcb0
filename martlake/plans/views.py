"""SQL surface: the staging models, marts and run log as temporary views.

Views are lazy plans, not copies. A dashboard's SQL (``SELECT * FROM
mart_revenue ORDER BY date_day``) runs through ``spark.sql`` and Catalyst
prunes and pushes down into the same plans the DataFrame API builds.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from martlake.params import MartParams
from martlake.plans import customers as cust
from martlake.plans import dashboard as dash
from martlake.plans import revenue as rev
from martlake.plans import staging as stg
from martlake.session import prepare, read_table


def register_views(spark: SparkSession, sf_dir: str, load_ts: str = "2024-01-01 00:00:00",
                   params: MartParams = MartParams()) -> list[str]:
    """Create (or replace) the views; returns their names."""
    prepare(spark)
    t = {n: read_table(spark, sf_dir, n) for n in
         ("orders", "part", "customer", "nation", "region", "lineitem", "events")}
    views = {
        "stg_orders": stg.stg_orders(stg.with_load_time(t["orders"], load_ts)),
        "stg_products": stg.stg_products(stg.with_load_time(t["part"], load_ts), params),
        "stg_customers": stg.stg_customers(stg.with_load_time(t["customer"], load_ts), t["nation"], t["region"]),
        "mart_revenue": rev.mart_revenue(t["lineitem"], t["orders"], t["part"], params),
        "mart_customer_analytics": cust.mart_customer_analytics(t["customer"], t["orders"], params),
        "pipeline_runs": dash.runs_from_events(t["events"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
