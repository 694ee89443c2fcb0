"""Tables that are published whole or not at all.

A table folder holds

* ``data/<id>/...``: data folders, each written once by one Spark job and never changed;
* ``_commits/<version>.json``: one small file for each version, created only if it is
  absent. It names the leaf folders that make up the version, its schema, its
  rows and free notes (a high-water mark, processed windows, source counts).

Readers resolve the newest complete commit file, so they see a version's data and its
notes together. A job that dies between its data and its commit leaves a folder
that nobody reads; the old version and its marks stay. Two writers that start from
the same version can't both commit.

Partitions: rows are written under helper columns (``_at_<column>``), so the leaf
files keep the columns themselves and one scan reads leaves of several loads. A
load that replaces some partitions only names the other leaves again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, AT = "_commits", "_at_"


class CommitConflict(RuntimeError):
    """Another writer has committed since this load began."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table. ``leaves`` are folders relative to the table; ``rows``
    are those that the version's own load wrote."""

    version: int
    leaves: tuple[str, ...] = ()
    schema: str = ""
    rows: int = 0
    notes: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"leaves": list(self.leaves), "schema": self.schema, "rows": self.rows, "notes": self.notes, "complete": True})


@dataclass(frozen=True)
class Pending:
    """Data written for a version that isn't committed yet."""

    path: str
    snapshot: Snapshot


# --- files, by the session's Hadoop file systems ----------------------------------

def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def listing(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is folder) of what a folder holds; nothing when it is absent."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(p)]


def create_only(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it exists already; whether it was written."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):  # another writer was first
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _leaves(spark: SparkSession, path: str, folder: str, depth: int) -> list[str]:
    """Partition folders below a data folder (the folder itself without partitions)."""
    if not depth:
        return [folder]
    out = []
    for name, is_folder in listing(spark, f"{path}/{folder}"):
        if is_folder and name.startswith(AT):
            out += _leaves(spark, path, f"{folder}/{name}", depth - 1)
    return sorted(out)


# --- versions ---------------------------------------------------------------------

def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all commit files, the newest first."""
    names = [n for n, _ in listing(spark, f"{path}/{COMMITS}")]
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def current(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest complete version (or the one asked for); None before the first."""
    for v in versions(spark, path):
        if version is not None and v != version:
            continue
        try:
            found = json.loads(read_text(spark, f"{path}/{COMMITS}/{v:020d}.json"))
        except ValueError:  # a writer died inside of its commit file: that version never was
            continue
        if found.get("complete"):
            return Snapshot(v, tuple(found["leaves"]), found["schema"], found["rows"], found["notes"])
    return None


def read(spark: SparkSession, path: str, version: int | None = None, only: set[str] | None = None) -> DataFrame:
    """Rows of a version. ``only``: names of leaf folders (see ``leaf_name``) to read."""
    snap = current(spark, path, version)
    if snap is None:
        raise FileNotFoundError(f"{path}: no committed version")
    return read_snapshot(spark, path, snap, only)


def read_snapshot(spark: SparkSession, path: str, snap: Snapshot, only: set[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(snap.schema))
    leaves = [f"{path}/{x}" for x in snap.leaves if only is None or leaf_name(x) in only]
    if not leaves:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*leaves)


def leaf_name(leaf: str) -> str:
    """The part of a leaf's path that names its partition ('' without partitions)."""
    return "/".join(leaf.split("/")[2:])


def spread(df: DataFrame, folder_cols: list[str]) -> DataFrame:
    """Rows in ranges of the folder columns, a folder's rows in ranges of their hash:
    each task writes few folders, and a large folder is split over several tasks."""
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "variant", "array", "struct"))]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *[F.col(f"`{c}`") for c in folder_cols], F.xxhash64(*[F.col(f"`{c}`") for c in plain]))


def prepare(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "replace",
            notes: dict | None = None, base: Snapshot | None = None) -> Pending:
    """Write ``df`` for the next version of the table at ``path`` without publishing it.

    ``mode``: ``replace`` (the version is ``df`` alone), ``partitions`` (the leaves of
    partitions that ``df`` has no rows of are kept) or ``append`` (all are kept).
    ``base`` is the version that the load has read (default: the current one);
    notes that aren't given again are kept.
    """
    if mode not in ("replace", "partitions", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    partition_by = partition_by or []
    base = base or current(spark, path) or Snapshot(0)
    folder = f"data/{uuid.uuid4().hex}"
    schema = df.schema
    rows = Observation()
    helpers = [f"{AT}{c}" for c in partition_by]
    if helpers:
        df = spread(df.withColumns({h: F.col(f"`{c}`").cast("string") for h, c in zip(helpers, partition_by, strict=True)}), helpers)
    # counted behind the exchange: what samples its ranges would count the rows once more
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.partitionBy(*helpers).parquet(f"{path}/{folder}")
    new = _leaves(spark, path, folder, len(partition_by))
    named = {leaf_name(x) for x in new}
    kept = {"replace": [], "append": list(base.leaves),
            "partitions": [x for x in base.leaves if leaf_name(x) not in named]}[mode]
    found = int(rows.get.get("rows", 0))
    return Pending(path, Snapshot(base.version + 1, tuple(kept + new), schema.json(), found, {**base.notes, **(notes or {})}))


def commit(spark: SparkSession, pending: Pending) -> Snapshot:
    """Publish prepared data: the one step that readers can see."""
    snap = pending.snapshot
    while not create_only(spark, f"{pending.path}/{COMMITS}/{snap.version:020d}.json", snap.text()):
        if current(spark, pending.path, snap.version) is not None:
            raise CommitConflict(f"{pending.path}: version {snap.version} exists")
        snap = replace(snap, version=snap.version + 1)  # a broken commit file has that number
    return snap


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "replace",
            notes: dict | None = None, base: Snapshot | None = None) -> Snapshot:
    """``prepare`` and ``commit``."""
    return commit(df.sparkSession, prepare(df, path, partition_by, mode, notes, base))


def note(spark: SparkSession, path: str, notes: dict, base: Snapshot | None = None) -> Snapshot:
    """A version with the same data and more notes."""
    base = base or current(spark, path) or Snapshot(0, (), T.StructType([]).json())
    return commit(spark, Pending(path, Snapshot(base.version + 1, base.leaves, base.schema, 0, {**base.notes, **notes})))


def leaf_values(leaf: str) -> tuple[str | None, ...]:
    """Partition values of a leaf as text (null and empty text: None)."""
    found = [unquote(x.split("=", 1)[1]) for x in leaf_name(leaf).split("/") if x]
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in found)


def leaves_of(snap: Snapshot, rows: DataFrame, partition_by: list[str]) -> set[str]:
    """Names of the leaves that hold the partitions of ``rows``."""
    text = [F.col(f"`{c}`").cast("string").alias(f"p{i}") for i, c in enumerate(partition_by)]
    touched = {tuple(v or None for v in r) for r in rows.select(*text).distinct().collect()}  # at most the partitions of the table
    return {leaf_name(x) for x in snap.leaves if leaf_values(x) in touched}


def register_view(spark: SparkSession, name: str, path: str, version: int | None = None) -> None:
    """(Re)define a view on a version (the current one) in one catalog step. A table of that
    name is an error: replacing it would lose its data."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a view of this library")
    snap = current(spark, path, version)
    if snap is None:
        raise FileNotFoundError(f"{path}: no committed version")
    columns = T.StructType.fromJson(json.loads(snap.schema))
    chosen = ", ".join(f"`{c}`" for c in columns.names)
    folders = sorted({"/".join(x.split("/")[:2]) for x in snap.leaves})
    if not folders:
        source = "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns) + " WHERE false"
    elif len(folders) == 1:
        source = f"SELECT {chosen} FROM parquet.`{path}/{folders[0]}`"
    else:
        source = " UNION ALL ".join(f"SELECT {chosen} FROM parquet.`{path}/{x}`" for x in snap.leaves)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {source}")


def expire(spark: SparkSession, path: str, keep: int = 2, older_than_s: int = 86_400, now_s: float | None = None) -> list[str]:
    """Delete data folders that none of the newest ``keep`` versions names and that
    are older than ``older_than_s`` (a load may still be writing younger ones)."""
    import time
    kept = set()
    for v in versions(spark, path)[:keep]:
        snap = current(spark, path, v)
        kept |= {"/".join(x.split("/")[:2]) for x in snap.leaves} if snap else set()
    gone = []
    fs, p = _at(spark, f"{path}/data")
    for s in (fs.listStatus(p) if fs.exists(p) else []):
        folder = f"data/{s.getPath().getName()}"
        age = (now_s or time.time()) - s.getModificationTime() / 1000
        if folder not in kept and age > older_than_s:
            fs.delete(s.getPath(), True)
            gone.append(folder)
    return sorted(gone)
