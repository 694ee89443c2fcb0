"""Slowly changing dimension, type 2, as one plan.

The history of a key is the set of its versions, each known by the time it holds
from. A load adds versions to the set; ends and current flags are read off the
order of the starts. So a load that is repeated or comes late gives the history
that the loads in order would have given, with one surrogate key a version.

``as_of`` is one literal, and the surrogate key is a hash of (natural key,
valid_from): a retried task produces the same key, unlike a random id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM, VALID_TO, IS_CURRENT, SURROGATE = "_scd_valid_from", "_scd_valid_to", "_scd_is_current", "_surrogate_key"
SCD_COLUMNS = (VALID_FROM, VALID_TO, IS_CURRENT, SURROGATE)


def surrogate_key(keys: list[str], valid_from) -> F.Column:
    """Hash of the key's texts and ``valid_from``. Colons and backslashes in a text are
    escaped and a null is ``\\N``, so different keys never give one text."""
    parts = [F.coalesce(F.regexp_replace(F.col(k).cast("string"), r"([\\:])", r"\\$1"), F.lit("\\N"))
             for k in keys] + [F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss")]
    return F.sha2(F.concat_ws(":", *parts), 256)


def initial_history(df: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    ts = F.lit(as_of).cast("timestamp_ntz")
    return (df.withColumn(VALID_FROM, ts)
              .withColumn(VALID_TO, F.lit(None).cast("timestamp_ntz"))
              .withColumn(IS_CURRENT, F.lit(True))
              .withColumn(SURROGATE, surrogate_key(keys, ts)))


def _plain(df: DataFrame, cols: list[str]) -> list:
    """Columns as a hash takes them, each with a flag so that nulls count."""
    types = dict(df.dtypes)
    return [x for c in cols for x in (F.col(c).isNull(), F.to_json(c) if "map<" in types[c] or "variant" in types[c] else F.col(c))]


def splice(history: DataFrame, batch: DataFrame, keys: list[str], as_of: str,
           detect_changes: list[str] | None = None) -> DataFrame:
    """All versions of the keys in ``batch``, with ``batch`` valid from ``as_of``.

    A version is known by (key, valid_from), so a batch applied again changes
    nothing, and one applied late lands between its neighbours. If rows differ for
    one (key, valid_from) - a key repeated in a batch, a corrected replay - the
    batch's row replaces the history's, and of several batch rows the one with the
    greatest hash stays. Ends, current flags and surrogate keys follow from the
    versions' starts alone.

    With ``detect_changes`` a version whose tracked columns equal (null-safe) those
    of the version before it goes; batches in another order may then keep other
    versions, but every moment reads the same values as long as no batch comes in
    between later.
    """
    attrs = [c for c in history.columns if c not in SCD_COLUMNS]
    b = batch.select(*attrs).withColumn(VALID_FROM, F.lit(as_of).cast("timestamp_ntz")).withColumn("_given", F.lit(1))
    known = history.select(*attrs, VALID_FROM).withColumn("_given", F.lit(0))
    rows = known.unionByName(b).repartition(*keys)  # the one shuffle: versions and their order both follow the key
    others = [c for c in attrs if c not in keys]
    row = F.struct(*[F.col(c) for c in others], F.lit(0).alias("_"))
    one = rows.groupBy(*keys, VALID_FROM).agg(F.max_by(row, F.struct("_given", F.xxhash64(*_plain(rows, others)))).alias("_row")) \
        .select(*keys, VALID_FROM, *[F.col(f"_row.{c}").alias(c) for c in others])
    # null keys are keys like any other; a key's versions are as many as its loads
    order = Window.partitionBy(*keys).orderBy(VALID_FROM)
    if detect_changes:
        before = [F.lag(F.struct(c)).over(order) for c in detect_changes]
        same = reduce(lambda x, y: x & y, [p.isNotNull() & p.eqNullSafe(F.struct(c)) for p, c in zip(before, detect_changes, strict=True)])
        one = one.withColumn("_same", same).where(~F.col("_same")).drop("_same")
    ends = one.withColumn(VALID_TO, F.lead(VALID_FROM).over(order))
    return ends.select(*attrs, VALID_FROM, VALID_TO, F.col(VALID_TO).isNull().alias(IS_CURRENT),
                       surrogate_key(keys, F.col(VALID_FROM)).alias(SURROGATE))


def apply_scd2(history: DataFrame, batch: DataFrame, keys: list[str], as_of: str,
               detect_changes: list[str] | None = None) -> DataFrame:
    """New history after loading ``batch`` at ``as_of``: versions of keys that the batch
    doesn't have stay as they are, those of the others are spliced (``splice``)."""
    named = batch.select(*[F.col(k).alias(f"_hit_{k}") for k in keys]).distinct()
    hit = reduce(lambda x, y: x & y, [history[k].eqNullSafe(named[f"_hit_{k}"]) for k in keys])
    untouched = history.join(named, hit, "left_anti")
    touched = history.join(named, hit, "left_semi")
    return untouched.unionByName(splice(touched, batch, keys, as_of, detect_changes).select(*history.columns))


def as_of_view(history: DataFrame, at: str) -> DataFrame:
    """Versions valid at ``at``: valid_from <= at < valid_to (open end = current)."""
    t = F.lit(at).cast("timestamp_ntz")
    return history.filter((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > t)))
