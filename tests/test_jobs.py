"""Job-level replay properties: crash between data and mark, rerun, same state."""
import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from martlake.jobs import ingestion as J
from martlake.operators import control as CT
from martlake.operators import monitor as M
from martlake.operators import windows as W
from martlake.operators.fingerprint import fingerprint
from martlake.plans import dashboard as dash
from martlake.session import checkpoint_dir, read_table, scratch_path
from martlake.sinks import snapshots as SN

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _args(root):
    return dict(target_path=f"{root}/target", batches_path=f"{root}/batches", pipeline="p", table="orders",
                key=["o_orderkey"], mark_column="o_orderdate", default_start="1900-01-01 00:00:00")


def test_crash_before_the_commit_leaves_rows_and_mark_and_a_rerun_is_whole(spark, monkeypatch):
    orders = read_table(spark, SF, "orders")
    root = scratch_path(spark, "crash")
    J.run_incremental(spark, orders, window_end="1998-01-01 00:00:00", **_args(root))
    before = fingerprint(J.read_target(spark, f"{root}/target"), "t").first()

    def boom(*a, **k):
        raise RuntimeError("crash after the data write, before the commit")
    with monkeypatch.context() as m:
        m.setattr(SN, "create_only", boom)
        with pytest.raises(RuntimeError):
            J.run_incremental(spark, orders, window_end="2030-01-01 00:00:00", **_args(root))
    assert fingerprint(J.read_target(spark, f"{root}/target"), "t").first() == before
    assert SN.current(spark, f"{root}/target").notes["mark"] == "1998-01-01 00:00:00"
    J.run_incremental(spark, orders, window_end="2030-01-01 00:00:00", **_args(root))
    got = fingerprint(J.read_target(spark, f"{root}/target").select(*orders.columns), "t").first()
    assert got == fingerprint(orders, "t").first()
    assert SN.current(spark, f"{root}/target").notes["windows"] == [["1900-01-01 00:00:00", "2030-01-01 00:00:00"]]


def test_a_late_row_of_a_processed_window_is_loaded_with_lateness(spark):
    root = scratch_path(spark, "lateness")
    schema = "o_orderkey long, state string, o_orderdate timestamp_ntz"

    def source(*rows):
        return spark.createDataFrame([(k, s, dt.datetime(2024, 1, d)) for k, s, d in rows], schema)
    J.run_incremental(spark, source((1, "a", 3), (2, "b", 5)), window_end="2024-01-10 00:00:00", **_args(root))
    later = source((1, "a", 3), (2, "b", 5), (9, "late", 8), (3, "c", 12), (2, "older", 1))
    J.run_incremental(spark, later, window_end="2024-01-20 00:00:00", lateness="5 days", **_args(root))
    got = sorted(map(tuple, J.read_target(spark, f"{root}/target").select("o_orderkey", "state").collect()))
    assert got == [(1, "a"), (2, "b"), (3, "c"), (9, "late")]
    J.run_incremental(spark, later, window_end="2024-01-20 00:00:00", lateness="1 year", **_args(root))
    assert (2, "b") in set(map(tuple, J.read_target(spark, f"{root}/target").select("o_orderkey", "state").collect()))


def test_windows_without_rows_are_noted_and_gaps_found(spark):
    root = scratch_path(spark, "gaps")
    empty = spark.createDataFrame([], "o_orderkey long, state string, o_orderdate timestamp_ntz")
    path = f"{root}/target"
    assert J.missing_window(spark, path, "2024-01-01", "2024-02-01") == ("2024-01-01", "2024-02-01")
    J.run_incremental(spark, empty, window_start="2024-01-05", window_end="2024-01-10", **_args(root))
    J.run_incremental(spark, empty, window_start="2024-01-20", window_end="2024-01-25", **_args(root))
    assert J.missing_window(spark, path, "2024-01-05", "2024-01-25") == ("2024-01-10", "2024-01-20")
    J.run_incremental(spark, empty, window_start="2024-01-08", window_end="2024-01-21", **_args(root))
    assert J.missing_window(spark, path, "2024-01-05", "2024-01-25") is None
    assert J.missing_window(spark, path, "2024-01-01", "2024-01-25") == ("2024-01-01", "2024-01-05")


def test_islands_and_gaps_against_a_scan_of_points(spark):
    import random
    rnd = random.Random(5)
    rows = [(p, a, a + rnd.randint(-1, 4)) for p in ("x", "y", None) for a in (rnd.randint(0, 40) for _ in range(12))]
    df = spark.createDataFrame([*rows, ("x", None, 3)], "p string, start int, end int")
    for p in ("x", "y", None):
        points = {t for q, a, z in rows if q == p for t in range(a, z)}
        edges = [t for t in range(-1, 50) if (t in points) != (t - 1 in points)]
        want = list(zip(edges[::2], edges[1::2], strict=True))
        same = F.col("p").eqNullSafe(F.lit(p))
        assert sorted((r["start"], r["end"]) for r in W.islands(df, ["p"]).where(same).collect()) == want
        assert sorted((r["start"], r["end"]) for r in W.gaps(df, ["p"]).where(same).collect()) == list(zip(edges[1::2], edges[2::2], strict=False))


def test_buckets_grow_with_the_target(spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS_PER_BUCKET", 10)
    orders = read_table(spark, SF, "orders")
    root = scratch_path(spark, "buckets")
    for end in ("1993-01-01 00:00:00", "1996-01-01 00:00:00", "2030-01-01 00:00:00"):
        J.run_incremental(spark, orders, window_end=end, **_args(root))
    snap = SN.current(spark, f"{root}/target")
    assert snap.notes["buckets"] * 10 >= orders.count() > snap.notes["buckets"] * 5
    got = fingerprint(J.read_target(spark, f"{root}/target").select(*orders.columns), "t").first()
    assert got == fingerprint(orders, "t").first()


def test_scratch_paths_live_under_checkpoint_dir(spark):
    base = checkpoint_dir(spark).replace("file:", "")
    assert scratch_path(spark, "x").startswith(base)


def test_a_row_whose_mark_moves_to_another_month_replaces_its_older_version(spark):
    root = scratch_path(spark, "moved")
    schema = "o_orderkey long, state string, o_orderdate timestamp_ntz"

    def orders(*rows):
        return spark.createDataFrame([(k, s, dt.datetime(2024, m, d)) for k, s, m, d in rows], schema)
    J.run_incremental(spark, orders((1, "new", 1, 2), (1, "pending", 1, 9), (2, "pending", 1, 5)),
                      window_end="2024-01-31 00:00:00", **_args(root))
    J.run_incremental(spark, orders((1, "shipped", 2, 3), (3, "pending", 2, 4)),
                      window_end="2024-02-28 00:00:00", **_args(root))
    got = J.read_target(spark, f"{root}/target").select("o_orderkey", "state").collect()
    assert sorted(map(tuple, got)) == [(1, "shipped"), (2, "pending"), (3, "pending")]


def _entity(spark, name, days):
    df = spark.createDataFrame([(d, dt.date(2024, 1, d)) for d in days], "id long, d date")
    return J.EntitySpec(name, lambda: df, "id", "d")


def test_full_ingestion_replaces_and_registers_readable_tables(spark):
    root = scratch_path(spark, "whole")

    def load(days):
        return J.run_full_ingestion(spark, [_entity(spark, "whole_demo", days)], root, "2024-01-01", "2024-01-05 00:00:00").first()
    assert load([1, 2, 3])["rows_loaded"] == 3
    assert load([2])["rows_loaded"] == 1
    assert [r.id for r in spark.table("raw_whole_demo").collect()] == [2]
    spark.sql("DROP VIEW raw_whole_demo")
    fresh = M.freshness_of_loads(spark, {"whole_demo": f"{root}/raw/whole_demo", "gone": f"{root}/raw/gone"}, "2024-01-05 01:00:00").collect()
    assert {r["table"]: (r["age_hours"], r["is_fresh"]) for r in fresh} == {"whole_demo": (1.0, True), "gone": (None, False)}


def test_a_release_is_all_tables_or_none(spark, monkeypatch):
    root = scratch_path(spark, "release")
    J.run_full_ingestion(spark, [_entity(spark, "one", [1]), _entity(spark, "two", [1])], root, "2024-01-01")
    create, made = SN.create_only, []

    def second_fails(spark_, path, text):
        made.append(path)
        if len(made) == 2:
            raise RuntimeError("crash between the tables")
        return create(spark_, path, text)
    with monkeypatch.context() as m:
        m.setattr(SN, "create_only", second_fails)
        with pytest.raises(RuntimeError):
            J.run_full_ingestion(spark, [_entity(spark, "one", [1, 2]), _entity(spark, "two", [1, 2])], root, "2024-01-01")
    assert [J.read_release(spark, root, x).count() for x in ("one", "two")] == [1, 1]
    J.run_full_ingestion(spark, [_entity(spark, "one", [1, 2]), _entity(spark, "two", [1, 2])], root, "2024-01-01")
    assert [J.read_release(spark, root, x).count() for x in ("one", "two")] == [2, 2]


def test_run_log_survives_its_session(spark):
    path = scratch_path(spark, "runlog")
    log = CT.RunLog(spark, path)
    with log.run("r1", "load") as rec:
        spark.range(5).observe(rec["processed"], F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    with pytest.raises(ZeroDivisionError), log.run("r2", "load"):
        1 / 0
    with CT.RunLog(spark, path).run("r2", "load"):  # another attempt, another session's object
        pass
    got = CT.read_run_log(spark, path).collect()
    assert sorted((r["run_id"], r["attempt"], r["status"], r["rows_processed"]) for r in got) == [
        ("r1", 1, "success", 5), ("r2", 1, "failed", 0), ("r2", 2, "success", 0)]
    CT.compact_run_log(spark, path)
    assert CT.read_run_log(spark, path).count() == 3 and len(SN.current(spark, path).leaves) == 1
    assert [r["status"] for r in dash.latest_runs(CT.read_run_log(spark, path)).collect()].count("success") == 2
