"""Dataset fingerprints, digest trees and row-level differences.

The fingerprint is order-insensitive: a per-row 64-bit hash summed exactly as
decimal(38,0), plus the row count. Both are plain aggregates (partial sums per
task, no shuffle of rows), so any partitioning or row order gives the same
value.

A digest tree adds row hashes up per bucket of a hash, and buckets per level. Two
tables are compared leaf by leaf; only rows of unequal leaves are looked at, so a
comparison of large, nearly equal tables shuffles few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hashable(df: DataFrame) -> dict[str, Column]:
    """Columns as hashes and groups take them: maps and variants as JSON text."""
    return {c: F.to_json(F.col(f"`{c}`")) if "map<" in t or "variant" in t else F.col(f"`{c}`") for c, t in df.dtypes}


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's values, columns in name order, that tells nulls apart: hashes
    skip nulls, so the places of the nulls are hashed too (63 columns a number)."""
    cols = [c for _, c in sorted(_hashable(df).items())]
    places = [reduce(lambda x, y: x + y, [F.when(c.isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
                                          for i, c in enumerate(cols[at: at + 62])]) for at in range(0, len(cols), 62)]
    return F.xxhash64(*places, *cols)


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    return df.agg(
        F.lit(name).alias("table"),
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
        .cast("string").alias("fingerprint"))


# Fixed values of the portable row text: field separator and null marker.
FIELD_SEP = "\x1f"
NULL_MARK = "<null>"


def canonical_text(df: DataFrame):
    """Engine-independent text of a row: columns in name order, numbers as
    decimal(38,4) text, timestamps to the microsecond, nulls marked.

    Four decimals keep ``x * 10^4`` far below 2^53 for amounts under ~1e11, so
    engines that convert doubles by scaling in floating point still agree
    digit for digit; finer differences are not seen by this form (the default
    :func:`fingerprint` is bit-exact)."""
    types = dict(df.dtypes)
    parts = []
    for name in sorted(df.columns):
        t, c = types[name], F.col(name)
        if t in ("double", "float") or t.startswith("decimal"):
            s = c.try_cast("decimal(38,4)").cast("string")
        elif t.startswith("timestamp"):
            s = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif t == "date":
            s = F.date_format(c, "yyyy-MM-dd")
        elif t == "boolean":
            s = F.when(c, F.lit("true")).when(~c, F.lit("false"))
        else:
            s = c.cast("string")
        parts.append(F.coalesce(s, F.lit(NULL_MARK)))
    return F.concat_ws(FIELD_SEP, *parts)


def portable_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Order-insensitive fingerprint another engine can reproduce: the sum of
    the first 60 bits of md5(row text), exact. Slower than :func:`fingerprint`
    (md5 of a text row); used to compare across engines.

    The 60-bit value is summed as three 20-bit parts in plain longs (exact up
    to 2^43 rows) and recombined once; a decimal(38,0) running sum would go
    through arbitrary-precision arithmetic on every row.
    """
    hx = F.substring(F.md5(canonical_text(df)), 1, 15)
    parts = [F.conv(F.substring(hx, 1 + 5 * i, 5), 16, 10).cast("bigint") for i in range(3)]
    sums = df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.coalesce(F.sum(p), F.lit(0)).alias(f"_p{i}") for i, p in enumerate(parts)])
    d = "decimal(38,0)"
    total = (F.col("_p0").cast(d) * F.lit(1 << 40).cast(d) + F.col("_p1").cast(d) * F.lit(1 << 20).cast(d)
             + F.col("_p2").cast(d))
    return sums.select(F.lit(name).alias("table"), "row_count", total.cast(d).cast("string").alias("fingerprint"))


def fingerprints(tables: dict[str, DataFrame], portable: bool = False) -> DataFrame:
    fn = portable_fingerprint if portable else fingerprint
    return reduce(lambda a, b: a.unionByName(b), [fn(df, n) for n, df in tables.items()])


LEAF_BITS = 16  # leaves of a tree: 2^16, whatever the table's size
FANOUT_BITS = 8


def _leaf(df: DataFrame, keys: list[str] | None) -> Column:
    return F.shiftrightunsigned(row_hash(df.select(*keys)) if keys else row_hash(df), 64 - LEAF_BITS).cast("int")


def leaves(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(bucket, rows, low, high) of each leaf: rows and the sums of both halves of their
    hashes. Rows are dealt to leaves by ``keys`` (default: by all columns)."""
    low = F.col("_h").bitwiseAND(F.lit((1 << 32) - 1))
    return df.select(_leaf(df, keys).alias("bucket"), row_hash(df).alias("_h")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(F.shiftrightunsigned("_h", 32)).alias("high"))


def digest_tree(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(level, bucket, rows, low, high): level 0 is the whole table, the last level the
    leaves; a bucket's numbers are the sums of its children's."""
    found = leaves(df, keys)
    levels = range(LEAF_BITS // FANOUT_BITS + 1)
    up = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright("bucket", LEAF_BITS - i * FANOUT_BITS).alias("bucket"))
                             for i in levels])).alias("at")
    return found.select(up, "rows", "low", "high").groupBy(F.col("at.level").alias("level"), F.col("at.bucket").alias("bucket")) \
        .agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")])


def unequal_leaves(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(bucket) of the leaves in which the tables differ; at most 2^16 rows."""
    both = leaves(left, keys).unionByName(leaves(right, keys).select("bucket", *[(-F.col(c)).alias(c) for c in ("rows", "low", "high")]))
    sums = both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")])
    return sums.where((F.col("rows") != 0) | (F.col("low") != 0) | (F.col("high") != 0)).select("bucket")


def diff(left: DataFrame, right: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows that one side has more often: (columns..., side, copies).

    Rows of equal leaves are left out before anything is shuffled. The others are
    tagged +1 (left) or -1 (right) and summed per distinct row (map-side combine
    absorbs repeated rows); a sum n other than zero is |n| copies on the side its
    sign names. Nulls are equal to nulls, NaNs to NaNs.
    """
    cols = left.columns
    right = right.select(*cols)
    wrong = F.broadcast(unequal_leaves(left, right, keys).withColumnRenamed("bucket", "_bucket"))
    sides = [df.withColumn("_bucket", _leaf(df, keys)).join(wrong, "_bucket", "left_semi")
             .select(*[c.alias(n) for n, c in _hashable(df).items()], F.lit(sign).cast("bigint").alias("_d"))
             for df, sign in ((left, 1), (right, -1))]
    counts = sides[0].unionByName(sides[1]).groupBy(*[f"`{c}`" for c in cols]).agg(F.sum("_d").alias("_n")).where(F.col("_n") != 0)
    return counts.select(*[f"`{c}`" for c in cols],
                         F.when(F.col("_n") > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"),
                         F.abs("_n").alias("copies"))
