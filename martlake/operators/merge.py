"""Key-based load strategies as pure DataFrame functions (new state out).

* upsert: the batch is reduced to one row per key (latest by an explicit
  order), target rows whose key is in the batch are dropped (anti join) and
  the batch is appended. Inserting and updating are the same plan.
* upsert_partial: only the batch's columns are overwritten; other target
  columns keep their value (full outer join on the key).
* insert_ignore: rows whose key already exists are left alone.

Nulls in a key are values like any other. No side is marked for broadcast: Spark
picks the join by the sizes it sees, and AQE can change its mind. Publishing the
new state is the sink's job (``martlake.sinks``), which writes only the partitions
the batch touches; an insert-ignore load appends ``rows_to_insert``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.operators.dedup import latest_by_key


def _one_per_key(batch: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    """The batch with one row per key. Without ``order_by`` no row can be told to be the
    later one: a repeated key then fails the job when its rows are read."""
    if order_by:
        return latest_by_key(batch, keys, order_by)
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.dropDuplicates(keys)
    one = batch.groupBy(*keys).agg(F.any_value(F.struct(*others)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    twice = F.concat(F.lit("key repeated in the batch, and no order to choose by: "), F.to_json(F.struct(*keys)))
    checked = one.withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(twice)))
    return checked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*batch.columns)


def _absent(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key ``other`` lacks; a null is a key like any other, so a replayed
    batch with null keys replaces its rows instead of adding them again."""
    have = other.select(*[F.col(k).alias(f"_have_{k}") for k in keys]).distinct()
    same = reduce(lambda x, y: x & y, [rows[k].eqNullSafe(have[f"_have_{k}"]) for k in keys])
    return rows.join(have, same, "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           order_by: list[str] | None = None) -> DataFrame:
    """Insert new keys, replace existing ones with the batch row.

    A key repeated in the batch keeps the row with the greatest ``order_by``;
    without ``order_by`` it is an error.
    """
    b = _one_per_key(batch, keys, order_by).select(*target.columns)
    return _absent(target, b, keys).unionByName(b)


def upsert_partial(target: DataFrame, batch: DataFrame, keys: list[str],
                   order_by: list[str] | None = None) -> DataFrame:
    """Overwrite only the batch's non-key columns; keep the rest of the target row."""
    b = _one_per_key(batch, keys, order_by)
    new_cols = [c for c in b.columns if c not in keys]
    t, s = target.alias("t"), b.withColumn("_hit", F.lit(True)).alias("s")
    same = reduce(lambda x, y: x & y, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in new_cols:
            out.append(F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return t.join(s, same, "full_outer").select(*out)


def rows_to_insert(target: DataFrame, batch: DataFrame, keys: list[str],
                   order_by: list[str] | None = None) -> DataFrame:
    """The batch rows whose key the target lacks, one per key: all that an
    insert-or-ignore load has to write."""
    b = latest_by_key(batch, keys, order_by) if order_by else batch.dropDuplicates(keys)
    return _absent(b.select(*target.columns), target, keys)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str],
                  order_by: list[str] | None = None) -> DataFrame:
    """The target after appending ``rows_to_insert`` (ON CONFLICT DO NOTHING)."""
    return target.unionByName(rows_to_insert(target, batch, keys, order_by))


def apply_defaults(df: DataFrame, defaults: dict[str, Column | object],
                   types: dict[str, str] | None = None) -> DataFrame:
    """Add omitted columns with their default; a column that is present keeps
    its values, explicit nulls included (as a SQL column default does)."""
    types = types or {}
    out = df
    for name, value in defaults.items():
        if name in df.columns:
            continue
        col = value if isinstance(value, Column) else F.lit(value)
        if name in types:
            col = col.cast(types[name])
        out = out.withColumn(name, col)
    return out


def audit_columns(df: DataFrame, loaded_at: str, invocation_id: str) -> DataFrame:
    """Load time and invocation id, fixed per run (never now() per task)."""
    return (df.withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
              .withColumn("_invocation_id", F.lit(invocation_id)))
