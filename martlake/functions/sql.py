"""The macros as SQL functions, for users who write ``spark.sql``.

Spark SQL UDFs are inlined into the plan like any built-in expression (no
Python at run time). Registered per session as temporary functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = (
    # round() needs a constant scale, so the precision is fixed at 2 here;
    # functions.scalar.cents_to_dollars takes it as a parameter.
    """CREATE OR REPLACE TEMPORARY FUNCTION cents_to_dollars(cents DECIMAL(38,4))
       RETURNS DECIMAL(38,2) RETURN round(cents / 100.0, 2)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION safe_divide(n DOUBLE, d DOUBLE, dflt DOUBLE DEFAULT 0)
       RETURNS DOUBLE RETURN CASE WHEN d IS NULL OR d = 0 THEN dflt ELSE n / d END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION date_spine(start_date DATE, end_date DATE)
       RETURNS TABLE (date_day DATE)
       RETURN SELECT explode(CASE WHEN start_date <= end_date
                                  THEN sequence(start_date, end_date, INTERVAL 1 DAY)
                                  ELSE CAST(array() AS ARRAY<DATE>) END) AS date_day""",
)


def register_sql_functions(spark: SparkSession) -> None:
    for stmt in SQL_FUNCTIONS:
        spark.sql(stmt)
