"""Whole-job queries (F1-F5): each runs the job into a fresh folder under the
shared checkpoint directory and returns its published result."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.jobs import ingestion as J
from martlake.operators import checks as C
from martlake.operators import control as CT
from martlake.operators import monitor as M
from martlake.operators import windows as W
from martlake.plans import dashboard as dash
from martlake.registry import register
from martlake.registry.marts import MART_REVENUE_SQL, P
from martlake.registry.monitors import FRESHNESS_SQL, RECONCILE_SQL, _freshness, _reconcile
from martlake.session import prepare, read_table, scratch_path
from martlake.sinks import snapshots as SN

DEFAULT_DATE = "2024-01-31"


def _t(spark, sf_dir, name):
    prepare(spark)
    return read_table(spark, sf_dir, name)


@register("run_full_ingestion", """
SELECT 'customers' AS entity, count(*) AS rows_loaded FROM customer
UNION ALL SELECT 'products', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders""")
def q_run_full_ingestion(spark, sf_dir):
    root = scratch_path(spark, "full")
    entities = [
        J.EntitySpec("customers", lambda: _t(spark, sf_dir, "customer"), "c_custkey"),
        J.EntitySpec("products", lambda: _t(spark, sf_dir, "part"), "p_partkey"),
        J.EntitySpec("orders", lambda: _t(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate",
                     [C.accepted_values("o_orderstatus", ["F", "O", "P"]),
                      # conditional: only when the extract carries the column
                      *C.not_null("o_comment", if_present=True)]),
    ]
    return J.run_full_ingestion(spark, entities, root, DEFAULT_DATE)


@register("run_batch", MART_REVENUE_SQL)
def q_run_batch(spark, sf_dir):
    """Every third order is delivered twice; staging makes it one."""
    orders = _t(spark, sf_dir, "orders")
    twice = orders.unionAll(orders.where(F.col("o_orderkey") % 3 == 0))
    return J.run_batch(spark, twice, _t(spark, sf_dir, "part"), _t(spark, sf_dir, "lineitem"), P,
                       f"{scratch_path(spark, 'batch')}/analytics/mart_revenue", "2024-01-01 00:00:00",
                       "analytics_mart_revenue").orderBy("date_day")


def _incremental_args(root):
    return dict(target_path=f"{root}/target", batches_path=f"{root}/batches", pipeline="orders_incremental", table="orders",
                key=["o_orderkey"], mark_column="o_orderdate", default_start="1900-01-01 00:00:00")


@register("run_incremental", "SELECT * FROM orders")
def q_run_incremental(spark, sf_dir):
    """Two windows, then a replay of the last one: the target ends equal to
    the source, and the replay changes nothing."""
    orders = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "incr")
    J.run_incremental(spark, orders, window_end="1998-01-01 00:00:00", **_incremental_args(root))
    J.run_incremental(spark, orders, window_end="2030-01-01 00:00:00", **_incremental_args(root))
    J.run_incremental(spark, orders, window_end="2030-01-01 00:00:00", **_incremental_args(root),
                      window_start="1998-01-01 00:00:00")
    return J.read_target(spark, f"{root}/target")


LATE = 5  # every fifth order of the first window arrives after its window was loaded


@register("run_incremental_late", "SELECT * FROM orders")
def q_run_incremental_late(spark, sf_dir):
    """Orders that arrive late in a processed window: the next load's overlap of
    ``lateness`` picks them up. A window left out is found in the ledger and filled."""
    orders = _t(spark, sf_dir, "orders")
    args = _incremental_args(scratch_path(spark, "late"))
    first = F.col("o_orderdate") <= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    on_time = orders.where(~(first & (F.col("o_orderkey") % LATE == 0)))
    J.run_incremental(spark, on_time, window_end="1996-01-01 00:00:00", **args)
    # 1996 and 1997 are skipped at first; the overlap reaches back over the first window
    J.run_incremental(spark, orders, window_start="1998-01-01 00:00:00", window_end="2030-01-01 00:00:00", **args)
    start, end = J.missing_window(spark, args["target_path"], "1900-01-01 00:00:00", "2030-01-01 00:00:00")
    J.run_incremental(spark, orders, window_start=start, window_end=end, lateness="100 years", **args)
    if J.missing_window(spark, args["target_path"], "1900-01-01 00:00:00", "2030-01-01 00:00:00"):
        raise RuntimeError("the ledger still has a gap")
    return J.read_target(spark, args["target_path"])


@register("window_islands", """
WITH d AS (SELECT DISTINCT o_custkey AS pipeline, CAST(o_orderdate AS DATE) AS day FROM orders),
g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY pipeline ORDER BY day) AS INTEGER) AS island FROM d)
SELECT pipeline, min(day) AS "start", CAST(max(day) + 1 AS DATE) AS "end", count(*) AS windows FROM g GROUP BY pipeline, island""")
def q_window_islands(spark, sf_dir):
    """Each customer's days with orders as processed windows, coalesced."""
    days = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pipeline"), F.to_date("o_orderdate").alias("start")) \
        .distinct().withColumn("end", F.date_add("start", 1))
    return W.islands(days, ["pipeline"])


@register("window_gaps", """
WITH d AS (SELECT DISTINCT o_custkey AS pipeline, CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT pipeline, day, lead(day) OVER (PARTITION BY pipeline ORDER BY day) AS later FROM d)
SELECT pipeline, CAST(day + 1 AS DATE) AS "start", later AS "end" FROM n WHERE later > day + 1""")
def q_window_gaps(spark, sf_dir):
    """The stretches between each customer's order days."""
    days = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pipeline"), F.to_date("o_orderdate").alias("start")) \
        .distinct().withColumn("end", F.date_add("start", 1))
    return W.gaps(days, ["pipeline"])


PUBLISH_SQL = """
SELECT 'old rows' AS state, count(*) AS rows, '1998-01-01 00:00:00' AS mark FROM orders
WHERE o_orderdate <= TIMESTAMP '1998-01-01 00:00:00'
UNION ALL SELECT 'new rows', count(*), '2030-01-01 00:00:00' FROM orders"""


@register("atomic_publish", PUBLISH_SQL)
def q_atomic_publish(spark, sf_dir):
    """A load that dies between its data and its commit: readers still see the old rows
    with the old mark; the repeated load publishes both."""
    orders = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "atomic")
    args = _incremental_args(root)
    J.run_incremental(spark, orders, window_end="1998-01-01 00:00:00", **args)

    def state(name):
        snap = SN.current(spark, args["target_path"])
        return (name, SN.read_snapshot(spark, args["target_path"], snap).count(), snap.notes["mark"])
    # the next version's data is written, and the job ends there
    SN.prepare(orders.withColumn("_key_bucket", F.lit(0)), args["target_path"], ["_key_bucket"], notes={"mark": "2030-01-01 00:00:00"})
    before = state("old rows")
    J.run_incremental(spark, orders, window_end="2030-01-01 00:00:00", **args)
    return spark.createDataFrame([before, state("new rows")], "state string, rows bigint, mark string")


@register("run_quality", f"""
WITH f AS ({FRESHNESS_SQL}), r AS ({RECONCILE_SQL})
SELECT 'freshness' AS "check", "table" AS subject, is_fresh AS passed FROM f
UNION ALL SELECT 'reconcile', target, passed FROM r
UNION ALL SELECT 'distribution', 'orders.o_totalprice', true
UNION ALL SELECT 'route', CASE WHEN (SELECT bool_and(is_fresh) FROM f) AND (SELECT bool_and(passed) FROM r)
                               THEN 'ok' ELSE 'alert' END, true""")
def q_run_quality(spark, sf_dir):
    return J.run_quality(spark, _freshness(spark, sf_dir), _reconcile(spark, sf_dir),
                         [M.distribution(_t(spark, sf_dir, "orders"), "o_totalprice", "orders")])


@register("run_entity_load", """
SELECT 'customers' AS entity, 'loaded' AS status, count(*) AS rows FROM customer
UNION ALL SELECT 'products', 'loaded', count(*) FROM part
UNION ALL SELECT 'orders', 'loaded', count(*) FROM orders
UNION ALL SELECT 'events', 'loaded', count(*) FROM events
UNION ALL SELECT 'returns', 'no_data', CAST(0 AS BIGINT)""")
def q_run_entity_load(spark, sf_dir):
    root = scratch_path(spark, "entity")
    specs = [
        J.EntitySpec("customers", lambda: _t(spark, sf_dir, "customer"), "c_custkey"),
        J.EntitySpec("products", lambda: _t(spark, sf_dir, "part"), "p_partkey"),
        J.EntitySpec("orders", lambda: _t(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate"),
        J.EntitySpec("events", lambda: _t(spark, sf_dir, "events"), "event_id", "ts"),
        # returned lines: the test tables carry none, so this entity has no data
        J.EntitySpec("returns", lambda: _t(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "X"),
                     "l_orderkey", "l_shipdate"),
    ]
    rows = [J.run_entity_load(spark, s, root, DEFAULT_DATE) for s in specs]
    return spark.createDataFrame(rows, "entity string, status string, rows bigint")


@register("job_runs", """
SELECT 'orders_incremental' AS pipeline_name, 'success' AS status, n1 AS rows_processed, n1 AS rows_loaded, CAST(1 AS INTEGER) AS attempt
FROM (SELECT count(*) AS n1 FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01 00:00:00')
UNION ALL SELECT 'orders_incremental', 'success', n2, n2, CAST(2 AS INTEGER)
FROM (SELECT count(*) AS n2 FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00')
UNION ALL SELECT 'load_products', 'failed', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS INTEGER)
UNION ALL SELECT 'full_ingestion', 'success', count(*), count(*), CAST(1 AS INTEGER) FROM customer""")
def q_job_runs(spark, sf_dir):
    """The jobs' own run log, read back from its table: two attempts of a load, a load that
    the gate stops, a full ingestion."""
    root = scratch_path(spark, "logged")
    log = CT.RunLog(spark, f"{root}/log")
    orders = _t(spark, sf_dir, "orders")
    for end in ("1998-01-01 00:00:00", "2030-01-01 00:00:00"):
        J.run_incremental(spark, orders, window_end=end, **_incremental_args(root), log=log, run_id="nightly")
    refused = J.EntitySpec("products", lambda: _t(spark, sf_dir, "part").withColumn("p_partkey", F.lit(None).cast("bigint")), "p_partkey")
    try:
        J.run_entity_load(spark, refused, root, DEFAULT_DATE, log=log)
    except C.QualityGateError:
        pass
    customers = J.EntitySpec("logged_customers", lambda: _t(spark, sf_dir, "customer"), "c_custkey")
    J.run_full_ingestion(spark, [customers], root, DEFAULT_DATE, log=log)
    runs = CT.read_run_log(spark, f"{root}/log")
    shown = dash.latest_runs(runs).select("pipeline_name", "status", "start_time", "rows_processed", "rows_loaded")
    return shown.join(runs.select("pipeline_name", "start_time", "attempt"), ["pipeline_name", "start_time"]).drop("start_time")
