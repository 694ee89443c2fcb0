"""Monitoring, quarantine and fingerprint queries (C10-C18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import fingerprint as FP
from martlake.operators import monitor as M
from martlake.operators import quarantine as Q
from martlake.plans import derived as D
from martlake.registry import register
from martlake.session import prepare, read_table

AS_OF = "2024-01-31 00:00:00"
RECONCILE_GAPS = (50, 5)   # targets that lost 1/50 (inside 5 %) and 1/5 (outside)


def _t(spark, sf_dir, name):
    prepare(spark)
    return read_table(spark, sf_dir, name)


def _freshness(spark, sf_dir):
    return M.freshness({"events": (_t(spark, sf_dir, "events"), "ts"),
                        "orders": (_t(spark, sf_dir, "orders"), "o_orderdate")}, AS_OF)


def _fresh_sql(name, col):
    age = (f"round(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max({col})) AS DOUBLE) / 3600000000.0, 2)")
    return (f"SELECT '{name}' AS \"table\", CAST(max({col}) AS TIMESTAMP) AS last_load, {age} AS age_hours, "
            f"coalesce({age} < 2.0, false) AS is_fresh, CASE WHEN max({col}) IS NULL THEN 'no data' END AS error "
            f"FROM {name}")


FRESHNESS_SQL = _fresh_sql("events", "ts") + "\nUNION ALL\n" + _fresh_sql("orders", "o_orderdate")


@register("dq_freshness", FRESHNESS_SQL)
def q_dq_freshness(spark, sf_dir):
    return _freshness(spark, sf_dir)


def _reconcile(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    out = None
    for gap in RECONCILE_GAPS:
        r = M.reconcile(orders, orders.filter(F.col("o_orderkey") % gap != 0), "orders", f"orders_without_{gap}")
        out = r if out is None else out.unionByName(r)
    return out


def _reconcile_sql_one(gap):
    return f"""SELECT 'orders' AS source, 'orders_without_{gap}' AS target, s.n AS source_count, t.n AS target_count,
       abs(s.n - t.n) AS difference, greatest(CAST(s.n AS DOUBLE) * 0.05, 10.0) AS tolerance,
       abs(s.n - t.n) <= greatest(CAST(s.n AS DOUBLE) * 0.05, 10.0) AS passed
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM orders WHERE o_orderkey % {gap} <> 0) t"""


RECONCILE_SQL = "\nUNION ALL\n".join(_reconcile_sql_one(g) for g in RECONCILE_GAPS)


@register("dq_reconcile", RECONCILE_SQL)
def q_dq_reconcile(spark, sf_dir):
    return _reconcile(spark, sf_dir)


def _dist_sql(table, col):
    return (f"SELECT '{table}' AS \"table\", '{col}' AS \"column\", round(coalesce(avg({col}), 0.0), 6) AS mean, "
            f"round(coalesce(stddev_samp({col}), 0.0), 6) AS stddev, coalesce(CAST(min({col}) AS DOUBLE), 0.0) AS min, "
            f"coalesce(CAST(max({col}) AS DOUBLE), 0.0) AS max, count({col}) AS count FROM {table}")


@register("dq_distribution", _dist_sql("orders", "o_totalprice") + "\nUNION ALL\n" + _dist_sql("events", "value"))
def q_dq_distribution(spark, sf_dir):
    return M.distribution(_t(spark, sf_dir, "orders"), "o_totalprice", "orders").unionByName(
        M.distribution(_t(spark, sf_dir, "events"), "value", "events"))


@register("dq_zscore_rows", """
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_id, value, round((value - m) / CASE WHEN sd <> 0 THEN sd END, 6) AS zscore
FROM events, s
WHERE abs((value - m) / CASE WHEN sd <> 0 THEN sd END) > 3""")
def q_dq_zscore_rows(spark, sf_dir):
    return M.zscore_rows(_t(spark, sf_dir, "events"), "value", ["event_id"])


def daily_event_value(events):
    return events.groupBy(F.to_date("ts").alias("date_day")).agg(
        F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total_value"))


@register("dq_metric_anomaly", """
WITH d AS (SELECT CAST(ts AS DATE) AS date_day, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
           FROM events GROUP BY 1),
w AS (SELECT date_day, total_value,
             avg(total_value) OVER (ORDER BY date_day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS m,
             stddev_samp(total_value) OVER (ORDER BY date_day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS sd
      FROM d)
SELECT date_day, total_value, round(m, 6) AS trailing_mean, round(sd, 6) AS trailing_stddev,
       round((total_value - m) / CASE WHEN sd <> 0 THEN sd END, 6) AS zscore,
       coalesce(abs((total_value - m) / CASE WHEN sd <> 0 THEN sd END) > 3, false) AS is_anomaly
FROM w""")
def q_dq_metric_anomaly(spark, sf_dir):
    return M.metric_anomaly(daily_event_value(_t(spark, sf_dir, "events")), "date_day", "total_value")


@register("dq_route", f"""
WITH f AS ({FRESHNESS_SQL}), r AS ({RECONCILE_SQL}),
x AS (SELECT coalesce((SELECT bool_and(is_fresh) FROM f), true) AS freshness_ok,
             coalesce((SELECT bool_and(passed) FROM r), true) AS reconcile_ok)
SELECT freshness_ok, reconcile_ok, NOT (freshness_ok AND reconcile_ok) AS alert,
       CASE WHEN NOT (freshness_ok AND reconcile_ok) THEN 'alert' ELSE 'ok' END AS route
FROM x""")
def q_dq_route(spark, sf_dir):
    return M.route_alerts(spark, _freshness(spark, sf_dir), _reconcile(spark, sf_dir))


@register("extract_thresholds", """
SELECT o.n AS orders_count, p.n AS products_count, c.n AS customers_count, o.n + p.n + c.n AS total,
       o.n > 0 AND p.n > 0 AS passed
FROM (SELECT count(*) n FROM orders) o, (SELECT count(*) n FROM part) p, (SELECT count(*) n FROM customer) c""")
def q_extract_thresholds(spark, sf_dir):
    return M.extraction_thresholds({"orders": _t(spark, sf_dir, "orders"), "products": _t(spark, sf_dir, "part")},
                                   {"customers": _t(spark, sf_dir, "customer")})


# ------------------------------------------------------------------ C17

def order_rules():
    p = F.col("o_totalprice")
    return {
        "customer_present": F.col("o_custkey").isNotNull(),
        "price_valid": ~F.isnan(p) & (p >= 0) & (p <= 400000),
        "status_known": F.col("o_orderstatus").isin("F", "O"),
    }


@register("quarantine_split", f"""
WITH d AS {D.ORDERS_WITH_DEFECTS_SQL},
l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        list_filter([CASE WHEN NOT coalesce(o_custkey IS NOT NULL, false) THEN 'customer_present' END,
                     CASE WHEN NOT coalesce(NOT isnan(o_totalprice) AND o_totalprice >= 0 AND o_totalprice <= 400000, false)
                          THEN 'price_valid' END,
                     CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), false) THEN 'status_known' END],
                    lambda x: x IS NOT NULL) AS rejection_reasons
      FROM d)
SELECT *, len(rejection_reasons) > 0 AS quarantined FROM l""")
def q_quarantine_split(spark, sf_dir):
    orders = D.orders_with_defects(_t(spark, sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    labelled = Q.label(orders, order_rules())
    return labelled.withColumn("quarantined", F.size("rejection_reasons") > 0)


# ------------------------------------------------------------------ C18

FINGERPRINT_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _fingerprint_sql(table: str) -> str:
    from martlake.contracts import TABLE_SCHEMAS
    cols = sorted((c.split()[0], c.split()[1]) for c in TABLE_SCHEMAS[table].split(", "))
    parts = []
    for name, t in cols:
        if t in ("double", "float") or t.startswith("decimal"):
            s = f"CAST(TRY_CAST({name} AS DECIMAL(38,4)) AS VARCHAR)"
        elif t.startswith("timestamp"):
            s = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
        else:
            s = f"CAST({name} AS VARCHAR)"
        parts.append(f"coalesce({s}, '{FP.NULL_MARK}')")
    text = f"concat_ws(chr(31), {', '.join(parts)})"
    h = f"CAST(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) AS DECIMAL(38,0))"
    return (f"SELECT '{table}' AS \"table\", count(*) AS row_count, "
            f"CAST(coalesce(sum({h}), 0) AS VARCHAR) AS fingerprint FROM {table}")


@register("dataset_fingerprint", "\nUNION ALL\n".join(_fingerprint_sql(t) for t in FINGERPRINT_TABLES))
def q_dataset_fingerprint(spark, sf_dir):
    return FP.fingerprints({t: _t(spark, sf_dir, t) for t in FINGERPRINT_TABLES}, portable=True)


@register("dataset_diff", f"""
WITH r AS (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0
            THEN CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(1.1 AS DECIMAL(2,1)), 2) AS DOUBLE)
            ELSE o_totalprice END AS o_totalprice) FROM orders)
SELECT *, 'left_only' AS side, count(*) AS copies FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM r) GROUP BY ALL
UNION ALL
SELECT *, 'right_only' AS side, count(*) AS copies FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM orders) GROUP BY ALL""")
def q_dataset_diff(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    updated = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % D.BATCH_EVERY == 0,
                               D.raised_amount(F.col("o_totalprice"))).otherwise(F.col("o_totalprice")))
    return FP.diff(orders, updated, ["o_orderkey"])


NULL_PLACES_SQL = """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS x, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS y
           FROM orders)
SELECT CAST(count(*) AS BIGINT) AS rows, true AS hashes_differ, CAST(2 * count(*) AS BIGINT) AS rows_in_diff
FROM a WHERE coalesce(x, y) IS NOT NULL"""


@register("digest_null_places", NULL_PLACES_SQL)
def q_digest_null_places(spark, sf_dir):
    """Every order's customer in one of two columns, and in the other one: the same
    values with the null elsewhere. Digests and differences must see each row."""
    orders = _t(spark, sf_dir, "orders").where("o_custkey is not null")
    even = F.col("o_orderkey") % 2 == 0
    x, y = F.when(even, F.col("o_custkey")), F.when(~even, F.col("o_custkey"))
    left = orders.select("o_orderkey", x.alias("x"), y.alias("y"))
    right = orders.select("o_orderkey", y.alias("x"), x.alias("y"))
    a, b = (FP.fingerprint(df, "t").first() for df in (left, right))
    return FP.diff(left, right, ["o_orderkey"]).agg(F.sum("copies").alias("rows_in_diff")).select(
        F.lit(a["row_count"]).cast("bigint").alias("rows"), F.lit(a["fingerprint"] != b["fingerprint"]).alias("hashes_differ"), "rows_in_diff")
