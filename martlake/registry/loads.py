"""Load strategies, lake writer and control-table queries (B1-B12, F6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import checks as C
from martlake.operators import control as CT
from martlake.operators import merge as MG
from martlake.operators import scd2 as S
from martlake.plans import derived as D
from martlake.registry import register
from martlake.session import prepare, read_table, scratch_path
from martlake.sinks import clustered as CL
from martlake.sinks import lake as L
from martlake.sinks import snapshots as SN

KEY = ["o_orderkey"]
T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def _t(spark, sf_dir, name):
    prepare(spark)
    return read_table(spark, sf_dir, name)


# ------------------------------------------------------------------ B4 / B9

@register("upsert_merge", f"""
SELECT * FROM {D.UPSERT_TARGET_SQL} t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {D.UPSERT_BATCH_SQL})
UNION ALL SELECT * FROM {D.UPSERT_BATCH_SQL}""")
def q_upsert_merge(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return MG.upsert(D.upsert_target(orders), D.upsert_batch(orders), KEY, order_by=["o_orderdate"])


@register("upsert_clustered", """
SELECT * REPLACE (CASE WHEN o_orderkey >= (SELECT max(o_orderkey) - max(o_orderkey) // 100 FROM orders) THEN 'Z' ELSE o_orderstatus END
                  AS o_orderstatus) FROM orders""")
def q_upsert_clustered(spark, sf_dir):
    """The last hundredth of the keys gets a new status in a table clustered by key: the
    leaves that hold none of them keep their very files."""
    orders = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "clustered")
    n = orders.count()
    before = CL.publish_clustered(orders, path, "o_orderkey", max(1, n // 20))
    top = orders.agg(F.max("o_orderkey")).first()[0]
    batch = orders.where(F.col("o_orderkey") >= top - top // 100).withColumn("o_orderstatus", F.lit("Z"))
    after = CL.upsert_clustered(batch, path)
    if len(set(before.leaves) & set(after.leaves)) < len(before.leaves) - 2:
        raise RuntimeError("leaves without a key of the batch were written again")
    return CL.read_clustered(spark, path)


@register("upsert_partial", f"""
SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM {D.UPSERT_TARGET_SQL} t
FULL OUTER JOIN (SELECT o_orderkey, o_totalprice FROM {D.UPSERT_BATCH_SQL}) b ON t.o_orderkey = b.o_orderkey""")
def q_upsert_partial(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    batch = D.upsert_batch(orders).select("o_orderkey", "o_totalprice")
    return MG.upsert_partial(D.upsert_target(orders), batch, KEY)


@register("insert_ignore", f"""
SELECT * FROM {D.UPSERT_TARGET_SQL}
UNION ALL SELECT * FROM {D.UPSERT_BATCH_SQL} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {D.UPSERT_TARGET_SQL})""")
def q_insert_ignore(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return MG.insert_ignore(D.upsert_target(orders), D.upsert_batch(orders), KEY, order_by=["o_orderdate"])


# ------------------------------------------------------------------ B5

CUST_KEY = ["c_custkey"]
NEW_SEGMENT = "AUTOMOBILE-PLUS"
AS_OF_MID = "2024-01-01 12:00:00"


def _scd_inputs(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer")
    history = S.initial_history(customer, CUST_KEY, T0)
    batch = (customer.filter(F.col("c_custkey") % D.SCD_EVERY == 0)
             .withColumn("c_mktsegment", F.lit(NEW_SEGMENT)))
    return history, batch


def scd_result(spark, sf_dir):
    history, batch = _scd_inputs(spark, sf_dir)
    return S.apply_scd2(history, batch, CUST_KEY, T1)


def _sk(ts):
    return f"sha256(CAST(c_custkey AS VARCHAR) || ':' || '{ts}')"


SCD2_SQL = f"""(
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       TIMESTAMP '{T0}' AS _scd_valid_from,
       CASE WHEN c_custkey % {D.SCD_EVERY} = 0 THEN TIMESTAMP '{T1}' END AS _scd_valid_to,
       c_custkey % {D.SCD_EVERY} <> 0 AS _scd_is_current,
       {_sk(T0)} AS _surrogate_key
FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, '{NEW_SEGMENT}', TIMESTAMP '{T1}', CAST(NULL AS TIMESTAMP), true,
       {_sk(T1)}
FROM customer WHERE c_custkey % {D.SCD_EVERY} = 0)"""


@register("scd2_apply", f"SELECT * FROM {SCD2_SQL}")
def q_scd2_apply(spark, sf_dir):
    return scd_result(spark, sf_dir)


@register("scd2_as_of", f"""
SELECT * FROM {SCD2_SQL} h
WHERE _scd_valid_from <= TIMESTAMP '{T1}' AND (_scd_valid_to IS NULL OR _scd_valid_to > TIMESTAMP '{T1}')
UNION ALL
SELECT * FROM {SCD2_SQL} h
WHERE _scd_valid_from <= TIMESTAMP '{AS_OF_MID}' AND (_scd_valid_to IS NULL OR _scd_valid_to > TIMESTAMP '{AS_OF_MID}')""")
def q_scd2_as_of(spark, sf_dir):
    h = scd_result(spark, sf_dir)
    return S.as_of_view(h, T1).unionByName(S.as_of_view(h, AS_OF_MID))


REPLAY_SQL = f"""
WITH h AS (
  SELECT c_custkey, c_mktsegment, TIMESTAMP '{T0}' AS t FROM customer
  UNION ALL SELECT c_custkey, '{NEW_SEGMENT}', TIMESTAMP '{T1}' FROM customer WHERE c_custkey % {D.SCD_EVERY} = 0
  UNION ALL SELECT c_custkey, 'LATER', TIMESTAMP '2024-01-03 00:00:00' FROM customer WHERE c_custkey % 4 = 0),
v AS (SELECT c_custkey, c_mktsegment, t AS _scd_valid_from, lead(t) OVER (PARTITION BY c_custkey ORDER BY t) AS _scd_valid_to FROM h)
SELECT loads, v.*, _scd_valid_to IS NULL AS _scd_is_current,
       sha256(CAST(c_custkey AS VARCHAR) || ':' || strftime(_scd_valid_from, '%Y-%m-%d %H:%M:%S')) AS _surrogate_key
FROM v, (VALUES ('in order'), ('reversed'), ('twice')) AS l(loads)"""


@register("scd2_replay", REPLAY_SQL)
def q_scd2_replay(spark, sf_dir):
    """Two batches applied in order, in reverse, and each twice: one history."""
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    history = S.initial_history(customer, CUST_KEY, T0)
    first = customer.where(F.col("c_custkey") % D.SCD_EVERY == 0).withColumn("c_mktsegment", F.lit(NEW_SEGMENT)), T1
    second = customer.where(F.col("c_custkey") % 4 == 0).withColumn("c_mktsegment", F.lit("LATER")), "2024-01-03 00:00:00"
    out = None
    for name, loads in (("in order", [first, second]), ("reversed", [second, first]), ("twice", [first, second, second, first])):
        h = history
        for batch, as_of in loads:
            h = S.apply_scd2(h, batch, CUST_KEY, as_of)
        h = h.withColumn("loads", F.lit(name))
        out = h if out is None else out.unionByName(h)
    return out


# ------------------------------------------------------------------ B11 / D4

DEFAULTS = {"status": "pending", "quantity": 1, "currency": "USD", "_ingestion_timestamp": T0}
DEFAULT_TYPES = {"quantity": "int", "_ingestion_timestamp": "timestamp_ntz"}


@register("apply_defaults", f"""
SELECT o_orderkey, o_custkey, o_totalprice, 'pending' AS status, CAST(1 AS INTEGER) AS quantity,
       'USD' AS currency, TIMESTAMP '{T0}' AS _ingestion_timestamp
FROM orders""")
def q_apply_defaults(spark, sf_dir):
    partial = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return MG.apply_defaults(partial, DEFAULTS, DEFAULT_TYPES)


INVOCATION = "inv-0001"


@register("audit_columns", f"""
SELECT *, TIMESTAMP '{T0}' AS _loaded_at, '{INVOCATION}' AS _invocation_id FROM supplier""")
def q_audit_columns(spark, sf_dir):
    return MG.audit_columns(_t(spark, sf_dir, "supplier"), T0, INVOCATION)


# ------------------------------------------------------------------ B7 / B8

MARK_CUT = "1998-01-01"
FIRST_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def _marks(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    events = _t(spark, sf_dir, "events")
    first = CT.marks_from(orders.filter(F.col("o_orderdate") < F.lit(MARK_CUT).cast("timestamp_ntz")),
                          "orders_incremental", "o_orderpriority", "o_orderdate", T0)
    later = CT.marks_from(orders.filter((F.col("o_orderdate") >= F.lit(MARK_CUT).cast("timestamp_ntz"))
                                        & F.col("o_orderpriority").isin(*FIRST_PRIORITIES)),
                          "orders_incremental", "o_orderpriority", "o_orderdate", T1)
    ev = CT.marks_from(events, "events_incremental", "event_type", "ts", T1)
    marks = CT.save_marks(CT.empty_marks(spark), first)
    return CT.save_marks(marks, later.unionByName(ev))


def _mark_sql(pipeline, table_col, value_col, src, ts):
    return (f"SELECT '{pipeline}' AS pipeline_name, {table_col} AS table_name, "
            f"strftime(max({value_col}), '%Y-%m-%d %H:%M:%S') AS watermark_value, "
            f"TIMESTAMP '{ts}' AS updated_at FROM {src} GROUP BY {table_col}")


_IN = ", ".join(f"'{p}'" for p in FIRST_PRIORITIES)
MARKS_SQL = f"""(
WITH first AS ({_mark_sql('orders_incremental', 'o_orderpriority', 'o_orderdate',
                          f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MARK_CUT}')", T0)}),
later AS ({_mark_sql('orders_incremental', 'o_orderpriority', 'o_orderdate',
                     f"(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{MARK_CUT}' AND o_orderpriority IN ({_IN}))", T1)}
          UNION ALL {_mark_sql('events_incremental', 'event_type', 'ts', 'events', T1)})
SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.pipeline_name = f.pipeline_name
                                         AND l.table_name = f.table_name)
UNION ALL SELECT * FROM later)"""


@register("watermark_upsert", f"SELECT * FROM {MARKS_SQL}")
def q_watermark_upsert(spark, sf_dir):
    return _marks(spark, sf_dir)


@register("watermark_lookup", f"""
SELECT * FROM {MARKS_SQL} WHERE pipeline_name = 'orders_incremental' AND table_name IN ('1-URGENT', '5-LOW')""")
def q_watermark_lookup(spark, sf_dir):
    m = _marks(spark, sf_dir)
    return CT.lookup_mark(m, "orders_incremental", "1-URGENT").unionByName(
        CT.lookup_mark(m, "orders_incremental", "5-LOW"))


# ------------------------------------------------------------------ B1 / B2 / B3 / A13 / A15

@register("lake_partition_counts", """
SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
       count(*) AS row_count
FROM orders GROUP BY 1, 2, 3""")
def q_lake_partition_counts(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "lake_orders")
    L.write_partitioned(orders, path, "o_orderdate")
    back = L.read_partitioned(spark, path, orders.schema)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("row_count"))


@register("incremental_batch_id", """
SELECT o_orderpriority,
       'orders_' || strftime(min(o_orderdate), '%Y%m%d_%H%M%S') || '_' || strftime(max(o_orderdate), '%Y%m%d_%H%M%S')
         AS batch_id,
       count(*) AS row_count
FROM orders GROUP BY 1""")
def q_incremental_batch_id(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    from martlake.functions.scalar import batch_stamp
    return orders.groupBy("o_orderpriority").agg(
        F.concat_ws("_", F.lit("orders"), batch_stamp(F.min("o_orderdate")), batch_stamp(F.max("o_orderdate")))
        .alias("batch_id"),
        F.count(F.lit(1)).alias("row_count"))


@register("lake_scan", "SELECT * FROM supplier")
def q_lake_scan(spark, sf_dir):
    sup = _t(spark, sf_dir, "supplier")
    path = scratch_path(spark, "lake_supplier")
    L.write_partitioned(sup, path, None, default_date="2024-01-31")
    return spark.read.parquet(path).drop(*L.PARTS)


@register("full_refresh", "SELECT * FROM supplier")
def q_full_refresh(spark, sf_dir):
    sup = _t(spark, sf_dir, "supplier")
    path = scratch_path(spark, "refresh_supplier")
    L.full_refresh(sup.filter(F.col("s_suppkey") < 0), path)   # an earlier, different state
    L.full_refresh(sup, path)                                 # replaced wholesale
    return SN.read(spark, path)


@register("table_scan", "SELECT * FROM supplier")
def q_table_scan(spark, sf_dir):
    sup = _t(spark, sf_dir, "supplier")
    path = scratch_path(spark, "table_supplier")
    L.full_refresh(sup, path, table="raw_supplier")
    return spark.table("raw_supplier")


# ------------------------------------------------------------------ F6

@register("run_log", """
SELECT 'r1' AS run_id, 'load_supplier' AS pipeline_name, 'success' AS status,
       CAST((SELECT count(*) FROM supplier) AS BIGINT) AS rows_processed,
       CAST((SELECT count(*) FROM supplier) AS BIGINT) AS rows_loaded
UNION ALL
SELECT 'r2', 'load_orders', 'failed', CAST((SELECT count(*) FROM orders) AS BIGINT), CAST(0 AS BIGINT)""")
def q_run_log(spark, sf_dir):
    """Two logged runs, read back from the log's table by another session's reader."""
    path = scratch_path(spark, "runlog")
    log = CT.RunLog(spark, path)
    sup = _t(spark, sf_dir, "supplier")
    with log.run("r1", "load_supplier") as rec:
        sup.observe(rec["processed"], F.count(F.lit(1)).alias("rows")) \
           .observe(rec["loaded"], F.count(F.lit(1)).alias("rows")).write.parquet(scratch_path(spark, "runlog_supplier"))
    orders = _t(spark, sf_dir, "orders")
    try:
        with log.run("r2", "load_orders") as rec:
            counted = orders.observe(rec["processed"], F.count(F.lit(1)).alias("rows"))
            C.enforce_gate(C.run_checks(counted, [C.row_count(1, 100)], "orders"))
    except C.QualityGateError:
        pass
    return CT.read_run_log(spark, path).select("run_id", "pipeline_name", "status", "rows_processed", "rows_loaded")
