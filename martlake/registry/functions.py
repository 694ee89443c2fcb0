"""Scalar-function and calendar queries (D1-D3, D6) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.functions.calendar import date_spine_between
from martlake.functions.scalar import NUMERIC_TEXT, cents_to_dollars, money, rate, safe_divide, to_number
from martlake.registry import register
from martlake.session import prepare, read_table


def _t(spark, sf_dir, name):
    prepare(spark)
    return read_table(spark, sf_dir, name)


@register("fn_cents_to_dollars", """
WITH c AS (SELECT l_orderkey, l_linenumber,
                  CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * 100 AS cents
           FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(cents AS DOUBLE) AS cents,
       CAST(round(CAST(cents AS DECIMAL(38,4)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS dollars
FROM c""")
def q_fn_cents_to_dollars(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    cents = money("l_extendedprice") * (F.lit(1) - rate("l_discount")) * F.lit(100)
    return li.select("l_orderkey", "l_linenumber", cents.alias("c")).select(
        "l_orderkey", "l_linenumber", F.col("c").cast("double").alias("cents"),
        cents_to_dollars("c").cast("double").alias("dollars"))


@register("fn_safe_divide", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN d IS NULL OR d = 0 THEN 0 ELSE l_tax / d END AS tax_per_discount,
       CASE WHEN d IS NULL OR d = 0 THEN -1.0 ELSE l_quantity / d END AS qty_per_discount
FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS d FROM lineitem)""")
def q_fn_safe_divide(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    d = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber",
                     safe_divide(F.col("l_tax"), d).cast("double").alias("tax_per_discount"),
                     safe_divide(F.col("l_quantity"), d, F.lit(-1.0)).alias("qty_per_discount"))


# Text forms exercised by the string-to-number coercion.
NUMBER_TOKENS = ("x", "", " 2 ", "1d", "NaN", "1_000", "1,5", "1e3", ".5", "+3", "inf")


def _text_sql():
    cases = " ".join(f"WHEN o_orderkey % 12 = {i + 1} THEN '{t}'" for i, t in enumerate(NUMBER_TOKENS))
    return f"CASE {cases} ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END"


@register("fn_to_number", f"""
SELECT o_orderkey, txt,
       CASE WHEN regexp_matches(txt, '{NUMERIC_TEXT}') THEN TRY_CAST(trim(txt) AS DOUBLE) END AS num
FROM (SELECT o_orderkey, {_text_sql()} AS txt FROM orders)""")
def q_fn_to_number(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    txt = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    for i, t in reversed(list(enumerate(NUMBER_TOKENS))):
        txt = F.when(F.col("o_orderkey") % 12 == i + 1, F.lit(t)).otherwise(txt)
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", to_number("txt").alias("num"))


@register("date_spine", """
SELECT CAST(d AS DATE) AS date_day
FROM (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders) x,
     generate_series(CAST(x.a AS TIMESTAMP), CAST(x.b AS TIMESTAMP), INTERVAL 1 DAY) g(d)""")
def q_date_spine(spark, sf_dir):
    bounds = _t(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"),
                                             F.max(F.to_date("o_orderdate")).alias("b"))
    return date_spine_between(bounds, "a", "b")
