"""Every registered query against its DuckDB oracle on the smallest tables."""
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import oracle_check as OC  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in OC.TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _keys():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    return sorted(E.queries()), E


KEYS, ENTRY = _keys()


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = ENTRY.queries()[key](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = ENTRY.oracle_sql().get(key)
    if sql is None:
        assert len(rows) >= 0
        return
    rel = duck.sql(sql)
    ocols, otypes, orows = rel.columns, rel.types, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert OC.type_mismatches(df.dtypes, ocols, otypes) == []
    assert len(rows) == len(orows)
    assert OC.digest(rows, cols, False)[0] == OC.digest(orows, ocols, False)[0]


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def test_fingerprint_is_order_insensitive(spark):
    from martlake.operators.fingerprint import fingerprint
    from martlake.session import read_table
    from pyspark.sql import functions as F
    orders = read_table(spark, SF, "orders")
    a = fingerprint(orders, "o").first()
    b = fingerprint(orders.orderBy(F.rand(3)).repartition(5), "o").first()
    assert a == b


def test_dashboard_sql_over_views(spark):
    from martlake.operators.fingerprint import fingerprint
    from martlake.plans.views import register_views
    assert "mart_revenue" in register_views(spark, SF)
    by_sql = spark.sql("SELECT * FROM mart_revenue ORDER BY date_day")
    by_df = ENTRY.queries()["mart_revenue"](spark, SF)
    assert fingerprint(by_sql, "m").first() == fingerprint(by_df.select(*by_sql.columns), "m").first()
    runs = spark.sql("""SELECT pipeline_name, status, start_time, end_time, rows_processed, rows_loaded,
                               error_message
                        FROM pipeline_runs ORDER BY start_time DESC NULLS FIRST, run_id DESC LIMIT 20""")
    want = ENTRY.queries()["latest_runs"](spark, SF)
    assert fingerprint(runs, "r").first() == fingerprint(want.select(*runs.columns), "r").first()
    kpi = spark.sql("SELECT sum(total_revenue) AS r, sum(total_orders) AS n FROM mart_revenue").first()
    assert kpi["n"] > 0
