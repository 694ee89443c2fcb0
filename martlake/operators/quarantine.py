"""Malformed-record rejection: every rule is a predicate; a row that breaks
any rule is quarantined with the list of reasons, the rest is valid.

One narrow projection (no shuffle). Both outputs derive from the same
labelled frame, so a caller that writes both should stage it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label(df: DataFrame, rules: dict[str, Column], reasons_col: str = "rejection_reasons") -> DataFrame:
    """Add ``rejection_reasons`` (names of broken rules, in rule order).

    A rule is the condition a GOOD row satisfies; a null result counts as broken.
    """
    flags = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    reasons = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return df.withColumn(reasons_col, reasons)


def split(df: DataFrame, rules: dict[str, Column], reasons_col: str = "rejection_reasons"):
    """(valid rows without the reasons column, quarantined rows with reasons)."""
    labelled = label(df, rules, reasons_col)
    bad = F.size(reasons_col) > 0
    return labelled.filter(~bad).drop(reasons_col), labelled.filter(bad)


def corrupt_record_rule(column: str = "_corrupt_record") -> dict[str, Column]:
    """Rule for sources read with ``mode=PERMISSIVE`` and a corrupt-record column."""
    return {"unparseable": F.col(column).isNull()}
