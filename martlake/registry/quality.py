"""Quality-check queries (C1-C9, B12) over the derived defect inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlake.operators import checks as C
from martlake.operators import constraints as CV
from martlake.plans import derived as D
from martlake.registry import register
from martlake.session import prepare, read_table

ORDERS_D = D.ORDERS_WITH_DEFECTS_SQL
ACCEPTED_STATUS = ("F", "O")
# Order priorities of the test tables.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PRICE_MIN, PRICE_MAX = 0.0, 400000.0
MIN_ROWS = 1000


def _inputs(spark, sf_dir):
    prepare(spark)
    orders = D.orders_with_defects(read_table(spark, sf_dir, "orders"))
    parent = D.customers_with_gaps(read_table(spark, sf_dir, "customer"))
    return orders, parent


def suite(parent) -> dict[str, list[C.Check]]:
    return {
        "not_null": C.not_null("o_orderkey", "o_custkey", "o_totalprice"),
        "unique": C.unique("o_orderkey", "o_custkey"),
        "accepted_values": [C.accepted_values("o_orderstatus", ACCEPTED_STATUS),
                            C.accepted_values("o_orderpriority", PRIORITIES)],
        "range": [C.in_range("o_totalprice", PRICE_MIN, PRICE_MAX)],
        "row_count": [C.row_count(MIN_ROWS)],
        "referential_integrity": [C.referential_integrity("o_custkey", parent, "c_custkey")],
    }


def suite_results(spark, sf_dir, kinds=None):
    orders, parent = _inputs(spark, sf_dir)
    s = suite(parent)
    chosen = [ck for k, v in s.items() if kinds is None or k in kinds for ck in v]
    return C.run_checks(orders, chosen, "orders")


# ------------------------------------------------------------------ oracle SQL

def _row(kind, column, passed, observed, detail="NULL"):
    col = "NULL" if column is None else f"'{column}'"
    return (f"SELECT '{kind}' AS \"check\", 'orders' AS target, CAST({col} AS VARCHAR) AS \"column\", "
            f"({passed}) AS passed, CAST({observed} AS BIGINT) AS observed, "
            f"CAST({detail} AS VARCHAR) AS detail, 'error' AS severity")


def _sql_not_null():
    parts = []
    for c in ("o_orderkey", "o_custkey", "o_totalprice"):
        pred = f"{c} IS NULL OR isnan({c})" if c == "o_totalprice" else f"{c} IS NULL"
        n = f"(SELECT count_if({pred}) FROM d)"
        parts.append(_row("not_null", c, f"{n} = 0", n))
    return parts


def _sql_unique():
    parts = []
    for c in ("o_orderkey", "o_custkey"):
        n = f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT {c}, count(*) AS n FROM d GROUP BY {c}))"
        parts.append(_row("unique", c, f"{n} = 0", n))
    return parts


ACCEPTED = (("o_orderstatus", ACCEPTED_STATUS), ("o_orderpriority", PRIORITIES))


def _sql_offending(column, values):
    inlist = ", ".join(f"'{v}'" for v in values)
    return (f"(SELECT coalesce(CAST({column} AS VARCHAR), 'NULL') AS v, count(*) AS n FROM d "
            f"WHERE {column} IS NULL OR {column} NOT IN ({inlist}) GROUP BY 1)")


def _sql_accepted():
    parts = []
    for c, vals in ACCEPTED:
        bad = _sql_offending(c, vals)
        n = f"(SELECT count(*) FROM {bad})"
        detail = f"CASE WHEN {n} > 0 THEN 'rows=' || CAST((SELECT sum(n) FROM {bad}) AS VARCHAR) END"
        parts.append(_row("accepted_values", c, f"{n} = 0", n, detail))
    return parts


def _sql_range():
    v = "CASE WHEN NOT isnan(o_totalprice) THEN CAST(o_totalprice AS DOUBLE) END"
    lo = f"(SELECT count_if({v} < {PRICE_MIN}) FROM d)"
    hi = f"(SELECT count_if({v} > {PRICE_MAX}) FROM d)"
    detail = f"'below_min=' || CAST({lo} AS VARCHAR) || ';above_max=' || CAST({hi} AS VARCHAR)"
    return [_row("range", "o_totalprice", f"{lo} + {hi} = 0", f"{lo} + {hi}", detail)]


def _sql_row_count():
    n = "(SELECT count(*) FROM d)"
    return [_row("row_count", None, f"{n} >= {MIN_ROWS}", n, f"'min={MIN_ROWS};max=none'")]


def _sql_ri():
    n = (f"(SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM d) x WHERE NOT EXISTS "
         f"(SELECT 1 FROM {D.CUSTOMERS_WITH_GAPS_SQL} p WHERE p.c_custkey IS NOT DISTINCT FROM x.o_custkey))")
    return [_row("referential_integrity", "o_custkey", f"{n} = 0", n, "'reference=c_custkey'")]


def _with_d(parts):
    return f"WITH d AS {ORDERS_D}\n" + "\nUNION ALL\n".join(parts)


ALL_PARTS = _sql_not_null() + _sql_unique() + _sql_accepted() + _sql_range() + _sql_row_count() + _sql_ri()


def _reg_kind(kind, parts):
    @register(f"dq_{kind}", _with_d(parts))
    def _q(spark, sf_dir, _kind=kind):
        return suite_results(spark, sf_dir, {_kind})
    return _q


_reg_kind("not_null", _sql_not_null())
_reg_kind("unique", _sql_unique())


@register("dq_accepted_values", f"WITH d AS {ORDERS_D}, r AS (\n" + "\nUNION ALL\n".join(_sql_accepted()) + """),
o AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS c, v, n FROM {_sql_offending(c, vals)}" for c, vals in ACCEPTED) + """)
SELECT r.*, o.v AS offender, o.n AS offender_rows FROM r LEFT JOIN o ON r."column" = o.c""")
def q_dq_accepted_values(spark, sf_dir):
    """Each check's result with all values it refuses, one row per value."""
    orders, parent = _inputs(spark, sf_dir)
    chosen = suite(parent)["accepted_values"]
    found = C.offenders(orders, chosen, "orders").select(
        "column", F.col("value").alias("offender"), F.col("rows").alias("offender_rows"))
    return C.run_checks(orders, chosen, "orders").join(found, "column", "left")


_reg_kind("range", _sql_range())
_reg_kind("row_count", _sql_row_count())
_reg_kind("referential_integrity", _sql_ri())

SUITE_SQL = f"WITH d AS {ORDERS_D}, r AS (\n" + "\nUNION ALL\n".join(ALL_PARTS) + ")\n"


@register("dq_summary", SUITE_SQL + """
SELECT count(*) AS total_checks, CAST(count_if(passed) AS BIGINT) AS passed,
       CAST(count_if(NOT passed) AS BIGINT) AS failed,
       CASE WHEN count(*) > 0 THEN count_if(passed) / count(*) ELSE 1.0 END AS pass_rate
FROM r""")
def q_dq_summary(spark, sf_dir):
    return C.summary(suite_results(spark, sf_dir))


# the same tests declared as data, and one that only warns
DECLARED = {
    "o_orderkey": ["not_null", "unique"],
    "o_orderstatus": [{"accepted_values": list(ACCEPTED_STATUS), "severity": "warn"}],
    "o_totalprice": [{"range": {"min": PRICE_MIN, "max": PRICE_MAX}}],
    "o_custkey": ["not_null", {"relationships": {"to": "customer", "field": "c_custkey"}}],
}
_DECLARED_SQL = [_sql_not_null()[0], _sql_unique()[0], _sql_accepted()[0].replace("'error' AS severity", "'warn' AS severity"),
                 *_sql_range(), _sql_not_null()[1], *_sql_ri()]


@register("dq_declared", _with_d(_DECLARED_SQL))
def q_dq_declared(spark, sf_dir):
    """Column tests from a declaration (``checks_from_spec``), dbt style."""
    orders, parent = _inputs(spark, sf_dir)
    return C.run_checks(orders, C.checks_from_spec(DECLARED, {"customer": parent}), "orders")


@register("dq_gate", SUITE_SQL + """
SELECT coalesce(list(lbl ORDER BY lbl), []) AS failed_checks, count(*) > 0 AS blocked
FROM (SELECT CASE WHEN "column" IS NULL THEN target || ':' || "check"
                  ELSE target || ':' || "check" || ':' || "column" END AS lbl
      FROM r WHERE NOT passed AND severity = 'error')""")
def q_dq_gate(spark, sf_dir):
    return C.gate_frame(suite_results(spark, sf_dir))


# ---------------------------------------------------------------- B12

@register("constraint_violations", """
SELECT 'primary_key' AS "constraint", 'l_orderkey,l_linenumber' AS columns,
       CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) n FROM lineitem GROUP BY l_orderkey, l_linenumber))
          + (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS BIGINT) AS violations
UNION ALL
SELECT 'not_null', 'l_orderkey', CAST(count_if(l_orderkey IS NULL) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'not_null', 'l_partkey', CAST(count_if(l_partkey IS NULL) AS BIGINT) FROM lineitem
UNION ALL
SELECT 'unique', 'l_orderkey', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
FROM (SELECT count(*) n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)
""")
def q_constraint_violations(spark, sf_dir):
    prepare(spark)
    li = read_table(spark, sf_dir, "lineitem")
    return CV.constraint_violations(li, ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"],
                                    ["l_orderkey"]).drop("passed")


# ---------------------------------------------------------------- C1 / A3

ORDERS_CONTRACT = {"o_orderkey": "integer", "o_custkey": "integer", "o_orderstatus": "string",
                   "o_totalprice": "float", "o_orderdate": "datetime", "o_orderpriority": "integer",
                   "o_comment": "string"}


@register("schema_validate", """
SELECT t.*, CASE t."column" WHEN 'o_orderkey' THEN c.a WHEN 'o_custkey' THEN c.b
                            WHEN 'o_orderstatus' THEN c.c WHEN 'o_totalprice' THEN c.d
                            WHEN 'o_orderdate' THEN c.e WHEN 'o_orderpriority' THEN c.f END AS non_null_values
FROM (VALUES
 ('o_orderkey', 'integer', 'bigint', true, true, true),
 ('o_custkey', 'integer', 'bigint', true, true, true),
 ('o_orderstatus', 'string', 'string', true, true, true),
 ('o_totalprice', 'float', 'double', true, true, true),
 ('o_orderdate', 'datetime', 'timestamp_ntz', true, true, true),
 ('o_orderpriority', 'integer', 'string', true, true, false),
 ('o_comment', 'string', NULL, false, true, false))
 AS t("column", expected, actual, present, required, compatible),
 (SELECT count(o_orderkey) AS a, count(o_custkey) AS b, count(o_orderstatus) AS c, count(o_totalprice) AS d,
         count(o_orderdate) AS e, count(o_orderpriority) AS f FROM orders) c""")
def q_schema_validate(spark, sf_dir):
    prepare(spark)
    return C.schema_report(read_table(spark, sf_dir, "orders"), ORDERS_CONTRACT)
