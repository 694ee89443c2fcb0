"""End-to-end jobs: full ingestion, incremental load, per-entity load, batch build
and quality run.

Every job stages its extracted batch once under the shared checkpoint folder
(a lineage cut that survives executor loss and avoids re-fetching a source),
checks the staged data with one fused aggregation per table, gates on the
collected check rows (a handful), and only then publishes.

Publishing is one commit file (``sinks.snapshots``). A full ingestion writes all its
tables first and then commits one *release* that names their versions: a crash
anywhere before leaves every reader with the release before. An incremental load
commits its rows, its mark and its ledger of windows together.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators import checks as C
from martlake.operators import control as CT
from martlake.operators import monitor as M
from martlake.operators import windows as W
from martlake.operators.dedup import latest_by_key
from martlake.params import MartParams
from martlake.plans import revenue as rev
from martlake.plans import staging as stg
from martlake.sinks import lake as L
from martlake.sinks import snapshots as SN
from martlake.sources.files import incremental_scan


@dataclass
class EntitySpec:
    name: str
    extract: Callable[[], DataFrame]
    key: str
    date_column: str | None = None
    checks: list = field(default_factory=list)


@contextmanager
def _logged(log: CT.RunLog | None, run_id: str | None, pipeline: str):
    """The run's record in ``log``; without a log a record that nobody keeps."""
    if log is None:
        yield {"counts": {}, "meta": {}}
    else:
        with log.run(run_id or pipeline, pipeline) as rec:
            yield rec


def stage_and_check(spec: EntitySpec) -> tuple[DataFrame, DataFrame]:
    staged = L.stage(spec.extract(), f"raw_{spec.name}")
    suite = [C.row_count(1), *C.not_null(spec.key), *C.unique(spec.key), *spec.checks]
    return staged, C.run_checks(staged, suite, spec.name)


def _release(lake_root: str) -> str:
    return f"{lake_root}/releases"


def read_release(spark: SparkSession, lake_root: str, entity: str) -> DataFrame:
    """An entity's rows in the lake's current release."""
    snap = SN.current(spark, _release(lake_root))
    if snap is None or entity not in snap.notes.get("tables", {}):
        raise FileNotFoundError(f"{lake_root}: no release of {entity}")
    return SN.read(spark, L.lake_path(lake_root, "raw", entity), snap.notes["tables"][entity])


def run_full_ingestion(spark: SparkSession, entities: list[EntitySpec], lake_root: str, default_date: str,
                       loaded_at: str | None = None, log: CT.RunLog | None = None, run_id: str | None = None) -> DataFrame:
    """Extract -> stage -> checks -> gate (all checks first) -> tables -> release.

    Every run replaces the whole table, date folders without new rows included.
    ``loaded_at`` (one text per run) is noted with each table for freshness checks.
    Returns one row per entity: name and rows of the published table. With ``log`` the
    run is recorded there, failed or not.
    """
    with _logged(log, run_id, "full_ingestion") as rec:
        rows = _full_ingestion(spark, entities, lake_root, default_date, loaded_at)
        rec["counts"].update(processed=sum(n for _, n in rows), loaded=sum(n for _, n in rows))
    return spark.createDataFrame(rows, "entity string, rows_loaded bigint")


def _full_ingestion(spark: SparkSession, entities: list[EntitySpec], lake_root: str, default_date: str,
                    loaded_at: str | None) -> list[tuple[str, int]]:
    checked = [(spec, *stage_and_check(spec)) for spec in entities]
    C.enforce_gate(reduce(lambda a, b: a.unionByName(b), [r for _, _, r in checked]))
    pending = {}
    for spec, staged, _ in checked:
        dated = L.with_date_partitions(staged, spec.date_column, default_date)
        pending[spec.name] = SN.prepare(dated, L.lake_path(lake_root, "raw", spec.name), L.PARTS,
                                        notes={"source": spec.name, "ingestion_date": default_date, "loaded_at": loaded_at})
    made = {name: SN.commit(spark, p) for name, p in pending.items()}
    before = SN.current(spark, _release(lake_root))
    tables = {**(before.notes.get("tables", {}) if before else {}), **{n: s.version for n, s in made.items()}}
    SN.note(spark, _release(lake_root), {"tables": tables}, before)
    rows = []
    for name, snap in made.items():
        SN.register_view(spark, f"raw_{name}", L.lake_path(lake_root, "raw", name), snap.version)
        rows.append((name, spark.table(f"raw_{name}").count()))
    return rows


def run_entity_load(spark: SparkSession, spec: EntitySpec, lake_root: str, default_date: str,
                    log: CT.RunLog | None = None, run_id: str | None = None) -> tuple:
    """One entity to the lake; an empty extract short-cuts to 'no_data'."""
    with _logged(log, run_id, f"load_{spec.name}") as rec:
        out = _entity_load(spark, spec, lake_root, default_date)
        rec["counts"].update(processed=out[2], loaded=out[2])
        rec["meta"]["status"] = out[1]
    return out


def _entity_load(spark: SparkSession, spec: EntitySpec, lake_root: str, default_date: str) -> tuple:
    staged = L.stage(spec.extract(), f"raw_{spec.name}")
    if staged.isEmpty():
        return (spec.name, "no_data", 0)
    C.enforce_gate(C.run_checks(staged, [*C.not_null(spec.key), *spec.checks], spec.name))
    dated = L.with_date_partitions(staged, spec.date_column, default_date)
    snap = SN.publish(dated, L.lake_path(lake_root, "raw", spec.name), L.PARTS, "partitions")
    return (spec.name, "loaded", snap.rows)


ROWS_PER_BUCKET = 1_000_000


def _buckets_for(rows: int) -> int:
    """Power of two with at most ``ROWS_PER_BUCKET`` rows a bucket on average, 8 at least."""
    n = 8
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def run_incremental(spark: SparkSession, source: DataFrame, target_path: str, batches_path: str,
                    pipeline: str, table: str, key: list[str], mark_column: str, window_end: str,
                    default_start: str, lateness: str | None = None, window_start: str | None = None,
                    log: CT.RunLog | None = None, run_id: str | None = None) -> dict:
    """Mark lookup -> window scan (pushed to the scan) -> idempotent batch write ->
    upsert into the target -> one commit of rows, mark and ledger of windows.

    The window is (mark, window_end]; ``window_start`` names another start, to fill
    a gap (``missing_window``). With ``lateness`` (an interval such as "2 days") the
    scan begins that much earlier: rows that arrived late in windows already
    processed are read again, and the upsert absorbs the others.

    The target is partitioned by key bucket, so a row whose mark moves replaces
    its older version; only the buckets present in the batch are read and written.
    Buckets double in number when they hold more than ``ROWS_PER_BUCKET`` rows on
    average. Of rows that repeat a key the one with the greatest mark stays, in the
    first load too, and a row never replaces one with a greater mark.
    """
    with _logged(log, run_id, pipeline) as rec:
        out = _incremental(spark, source, target_path, batches_path, pipeline, table, key, mark_column, window_end,
                           default_start, lateness, window_start)
        rec["counts"].update(processed=out["rows"], loaded=out["rows"])
        rec["meta"].update(batch_id=out["batch_id"], mark=out["mark"])
    return out


def _incremental(spark: SparkSession, source: DataFrame, target_path: str, batches_path: str, pipeline: str, table: str,
                 key: list[str], mark_column: str, window_end: str, default_start: str, lateness: str | None,
                 window_start: str | None) -> dict:
    base = SN.current(spark, target_path)
    notes = base.notes if base else {}
    start = window_start or notes.get("mark") or default_start
    window = incremental_scan(source, mark_column, start, lateness).filter(
        F.col(mark_column) <= F.lit(window_end).cast("timestamp_ntz"))
    batch = L.stage(window, f"batch_{table}")
    n, bid = batch.count(), None
    mark = max(window_end, notes.get("mark") or window_end)
    after = {"pipeline": pipeline, "table": table, "mark": mark, "windows": W.covered(notes.get("windows", []), start, window_end)}
    if not n:
        SN.note(spark, target_path, after, base)
        return {"batch_id": None, "rows": 0, "mark": mark}
    bid = L.write_incremental(batch, batches_path, mark_column, pipeline, (start, window_end))
    has_rows = base is not None and bool(base.leaves)
    total = n + (SN.read_snapshot(spark, target_path, base).count() if has_rows else 0)  # Parquet footers
    buckets = max(notes.get("buckets", 0), _buckets_for(total))
    bucketed = batch.withColumn(L.BUCKET, L.key_bucket(key, buckets))
    if has_rows:
        whole = buckets != notes["buckets"]
        old = SN.read_snapshot(spark, target_path, base, None if whole else SN.leaves_of(base, bucketed, [L.BUCKET]))
        if whole:
            old = old.withColumn(L.BUCKET, L.key_bucket(key, buckets))
        bucketed = old.unionByName(bucketed)
    SN.publish(latest_by_key(bucketed, key, [mark_column]), target_path, [L.BUCKET], "partitions" if has_rows and not whole else "replace",
               {**after, "buckets": buckets}, base)
    return {"batch_id": bid, "rows": n, "mark": mark}


def missing_window(spark: SparkSession, target_path: str, start: str, end: str) -> tuple[str, str] | None:
    """The earliest part of [start, end) that no committed load of the target covers."""
    snap = SN.current(spark, target_path)
    return W.first_gap(snap.notes.get("windows", []) if snap else [], start, end)


def read_target(spark: SparkSession, target_path: str) -> DataFrame:
    return SN.read(spark, target_path).drop(L.BUCKET)


def run_batch(spark: SparkSession, orders: DataFrame, products: DataFrame, lines: DataFrame, params: MartParams,
              mart_path: str, loaded_at: str, table: str | None = None, log: CT.RunLog | None = None,
              run_id: str | None = None) -> DataFrame:
    """Extract (raw written first) -> thresholds -> staging -> mart from staging -> mart
    tests -> gate -> publish; returns the published mart."""
    with _logged(log, run_id, "batch_marts") as rec:
        processed, loaded = _batch(spark, orders, products, lines, params, mart_path, loaded_at, table)
        rec["counts"].update(processed=processed, loaded=loaded)
    return SN.read(spark, mart_path)


def _batch(spark: SparkSession, orders: DataFrame, products: DataFrame, lines: DataFrame, params: MartParams, mart_path: str,
           loaded_at: str, table: str | None) -> tuple[int, int]:
    """(rows extracted, rows of the mart)"""
    raw = {n: L.stage(df, f"raw_{n}") for n, df in (("orders", orders), ("products", products), ("lines", lines))}
    enough = M.extraction_thresholds({"orders": raw["orders"], "products": raw["products"]}, {"lines": raw["lines"]})
    if not enough.first()["passed"]:
        raise C.QualityGateError(["extract_thresholds"])
    staged = {"orders": stg.stg_orders(stg.with_load_time(raw["orders"], loaded_at)),
              "products": stg.stg_products(stg.with_load_time(raw["products"], loaded_at))}
    C.enforce_gate(C.run_checks(staged["orders"], [*C.unique("order_id"), *C.not_null("customer_id")], "stg_orders"))
    mart = L.stage(rev.mart_revenue_staged(raw["lines"], staged["orders"], staged["products"], params), "mart_revenue")
    C.enforce_gate(C.run_checks(mart, [*C.unique("date_day"), *C.not_null("date_day", "total_revenue"),
                                       C.in_range("avg_gross_margin_pct", None, 100)], "mart_revenue"))
    loaded = L.full_refresh(mart, mart_path, table, {"loaded_at": loaded_at})
    return sum(df.count() for df in raw.values()), loaded


def run_quality(spark: SparkSession, freshness: DataFrame, reconciliation: DataFrame,
                distributions: list[DataFrame]) -> DataFrame:
    """(check, subject, passed) of every monitor and of the routing decision they lead to."""
    route = M.route_alerts(spark, freshness, reconciliation)
    parts = [freshness.select(F.lit("freshness").alias("check"), F.col("table").alias("subject"), F.col("is_fresh").alias("passed")),
             reconciliation.select(F.lit("reconcile").alias("check"), F.col("target").alias("subject"), "passed"),
             *(d.select(F.lit("distribution").alias("check"), F.concat_ws(".", "table", "column").alias("subject"),
                        F.lit(True).alias("passed")) for d in distributions),
             route.select(F.lit("route").alias("check"), F.col("route").alias("subject"), F.lit(True).alias("passed"))]
    return reduce(lambda a, b: a.unionByName(b), parts)
