"""Plan shape: pushdown, pruning, checked broadcasts, shuffle counts."""
import os

import pytest
from pyspark.sql import functions as F

from martlake.session import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_revenue_prunes_columns_and_broadcasts_checked_dims(spark):
    from martlake.plans.revenue import mart_revenue
    df = mart_revenue(read_table(spark, SF, "lineitem"), read_table(spark, SF, "orders"),
                      read_table(spark, SF, "part"))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p
    for pruned in ("l_shipdate", "l_tax", "l_returnflag", "o_totalprice", "p_name", "p_brand"):
        assert pruned not in p
    # one lineitem-sized exchange: the per-order aggregate
    assert p.count("hashpartitioning(l_orderkey") == 1


def test_date_range_reaches_the_scan(spark):
    from martlake.sources.ranges import date_range, key_pages
    orders = read_table(spark, SF, "orders")
    some = date_range(orders, "o_orderdate", "1997-01-01 00:00:00", "1998-01-01 00:00:00")
    scan = some._jdf.queryExecution().sparkPlan().toString()
    assert "GreaterThan(o_orderdate" in scan  # the plan's text is cut after some filters
    low, high = "1997-01-01", "1998-01-01"
    assert some.count() == orders.where(f"o_orderdate > timestamp_ntz'{low}' and o_orderdate <= timestamp_ntz'{high}'").count()
    page = key_pages(orders, "o_orderkey", 100, first=2, pages=1)
    assert "GreaterThanOrEqual(o_orderkey,200)" in plan(page) and {r["_page"] for r in page.collect()} == {2}


def test_cursors_skip_what_was_read(spark):
    from martlake.sources.ranges import after_cursor
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), ("a", None)], "shard string, k int")
    got = sorted(((r["_shard"], r["k"]) for r in after_cursor(df, "shard", "k", {"a": 1}).collect()), key=str)
    assert got == sorted([("a", 2), ("b", 1), (None, 1)], key=str)


def test_library_marks_no_side_for_broadcast(spark):
    from martlake.operators import merge as MG
    from martlake.operators import scd2 as S
    orders = read_table(spark, SF, "orders")
    history = S.initial_history(orders, ["o_orderkey"], "2024-01-01 00:00:00")
    for df in (MG.upsert(orders, orders.limit(10), ["o_orderkey"], ["o_orderdate"]), MG.insert_ignore(orders, orders, ["o_orderkey"]),
               S.apply_scd2(history, orders, ["o_orderkey"], "2024-01-02 00:00:00")):
        assert "hint" not in df._jdf.queryExecution().logical().toString().lower()


def test_dedup_is_an_aggregate_not_a_window(spark):
    from martlake.operators.dedup import latest_by_key
    df = latest_by_key(read_table(spark, SF, "orders"), ["o_custkey"], ["o_orderdate"])
    p = plan(df)
    assert "Window" not in p and "HashAggregate" in p or "ObjectHashAggregate" in p or "SortAggregate" in p


def test_unique_check_uses_partial_aggregation(spark):
    from martlake.operators import checks as C
    df = C.run_checks(read_table(spark, SF, "orders"), C.unique("o_custkey"), "orders")
    p = plan(df)
    assert p.count("HashAggregate") >= 2   # partial (map side) + final
