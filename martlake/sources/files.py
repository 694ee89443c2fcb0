"""File sources: CSV scans with lineage, manifests, header drift, profiles,
incremental (high-water mark) scans.

CSV files of one folder may differ in their columns. A header is one CSV record:
it is parsed from the first block of its file (quotes, doubled quotes, commas and
line breaks in quotes included), files are grouped by header, each group is one
scan with the group's own columns, and the scans are united by column name. Only
names, sizes and headers reach the driver, as much as Spark's own file listing.
Per-row facts come from the hidden ``_metadata`` column.
"""

from __future__ import annotations

import csv
import fnmatch
import io
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.scalar import parse_timestamp

# Text read as missing by the pandas CSV reader (its default
# na_values list). Matching is exact: " NA" or "-" stay text.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

FIRST_BLOCK = 64 * 1024  # bytes of a file read for its header; twice as many as long as the record goes on
OPENERS = 16  # files opened at a time


def _null_tokens(c: Column, tokens) -> Column:
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


@dataclass(frozen=True)
class CsvFile:
    path: str
    name: str
    size: int
    modified_ms: int
    header: tuple[str, ...]  # empty: the file has no record


def _is_whole(text: str) -> bool:
    """Whether the first record ends in ``text``: a line break outside of quotes."""
    quoted = False
    for c in text:
        if c == '"':
            quoted = not quoted  # a doubled quote toggles twice
        elif c in "\r\n" and not quoted:
            return True
    return False


def parse_header(block: str) -> tuple[str, ...]:
    """Column names of a file's first record. A name given twice gets ``.1``, ``.2`` ...
    behind it, an empty one is ``_c<position>``."""
    record = next(csv.reader(io.StringIO(block.removeprefix("\ufeff"), newline="")), [])
    seen: dict[str, int] = {}
    out = []
    for i, name in enumerate(record):
        name = name or f"_c{i}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return tuple(out)


def csv_files(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = False) -> list[CsvFile]:
    """The files in a folder (or the file ``path``) that match ``glob``, by path, with
    their headers. Hidden files are left out; subfolders are read if ``recursive`` or
    if they are partitions (``column=value``)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    if not fs.exists(top):
        raise FileNotFoundError(path)
    found, folders = [], []
    for s in fs.listStatus(top):
        (folders if s.isDirectory() else found).append(s)
    while folders:
        folder = folders.pop()
        name = folder.getPath().getName()
        if name.startswith(("_", ".")) and "=" not in name or not (recursive or "=" in name):
            continue
        for s in fs.listStatus(folder.getPath()):
            (folders if s.isDirectory() else found).append(s)

    def first_record(p) -> tuple[str, ...]:
        size = FIRST_BLOCK
        while True:
            stream = fs.open(p)
            try:
                raw = bytes(stream.readNBytes(size))
            finally:
                stream.close()
            text = raw.decode("utf-8", "replace")
            if len(raw) < size or _is_whole(text):
                return parse_header(text)
            size *= 2

    chosen = [s for s in found if not s.getPath().getName().startswith(("_", ".")) and fnmatch.fnmatch(s.getPath().getName(), glob)]
    with ThreadPoolExecutor(OPENERS) as pool:
        headers = list(pool.map(lambda s: first_record(s.getPath()), chosen))
    rows = [CsvFile(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime(), h)
            for s, h in zip(chosen, headers, strict=True)]
    return sorted(rows, key=lambda f: f.path)


def _reader(spark: SparkSession, header: tuple[str, ...], multiline: bool):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE") \
        .option("quote", '"').option("escape", '"').option("multiLine", multiline)


def csv_scan(spark: SparkSession, path: str, expected_columns: list[str] | None = None,
             run_ts: str | None = None, null_tokens=NULL_TOKENS, glob: str = "*.csv", multiline: bool = True,
             recursive: bool = False) -> DataFrame:
    """All-string CSV read with lineage columns; columns are found by name in each file.

    ``_source_file`` (file name), ``_source_size`` (its bytes), ``_chunk_start`` (byte
    offset of the file split the row came from) and ``_ingestion_timestamp`` (one
    literal per run). A file that lacks an expected column raises, naming file and
    column; extra columns are kept and null in the rows of files without them.
    ``multiline`` reads line breaks in quotes; without it large files are split.
    A folder without a file gives no rows, with the expected columns.
    """
    files = csv_files(spark, path, glob, recursive)
    lacking = {f.path: gone for f in files if f.header and (gone := sorted(set(expected_columns or []) - set(f.header)))}
    if lacking:
        raise ValueError(f"Missing expected columns: {lacking}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        if f.header:
            groups.setdefault(f.header, []).append(f.path)
    ts = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.current_timestamp().cast("timestamp_ntz")
    folder = any(f.path.rstrip("/").rsplit("/", 2)[-2].count("=") for f in files)
    parts = []
    for header, paths in groups.items():
        reader = _reader(spark, header, multiline)
        raw = (reader.option("basePath", path) if folder else reader).csv(paths)  # partition folders give columns
        parts.append(raw.select(*[_null_tokens(F.col(f"`{c}`"), null_tokens).alias(c) for c in raw.columns],
                                F.col("_metadata.file_name").alias("_source_file"),
                                F.col("_metadata.file_size").alias("_source_size"),
                                F.col("_metadata.file_block_start").alias("_chunk_start"),
                                ts.alias("_ingestion_timestamp")))
    if not parts:
        text = ", ".join(f"`{c}` string" for c in [*(expected_columns or []), "_source_file"])
        return spark.createDataFrame([], f"{text}, _source_size bigint, _chunk_start bigint, _ingestion_timestamp timestamp_ntz")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def typed_csv_scan(spark: SparkSession, path: str, schema: str,
                   corrupt_column: str = "_corrupt_record") -> DataFrame:
    """CSV read against a declared schema; a line that does not fit (bad
    number, bad timestamp, wrong field count) keeps its raw text in
    ``corrupt_column`` instead of failing the job (PERMISSIVE mode). Pair with
    ``operators.quarantine.corrupt_record_rule`` to split it off."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    st = T.StructType(list(st.fields) + [T.StructField(corrupt_column, T.StringType())])
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_column).schema(st).csv(path))


def _listing(spark: SparkSession, files: list[CsvFile]) -> DataFrame:
    return spark.createDataFrame([(f.path, f.name, f.size, f.modified_ms, list(f.header)) for f in files],
                                 "file_path string, file_name string, file_size bigint, modified_ms bigint, columns array<string>") \
        .select("file_path", "file_name", "file_size", F.timestamp_millis("modified_ms").alias("file_modification_time"), "columns")


def directory_manifest(spark: SparkSession, path: str, glob: str = "*.csv", multiline: bool = True,
                       recursive: bool = False) -> DataFrame:
    """One row per file under ``path`` matching ``glob``: path, name, size, modification
    time and data rows (0 for a file that holds a header alone), ordered by name.
    Rows are counted without parsing a column."""
    files = csv_files(spark, path, glob, recursive)
    listed = _listing(spark, files).drop("columns")
    named = [f.path for f in files if f.header]
    if not named:
        return listed.withColumn("rows", F.lit(0).cast("bigint")).orderBy("file_name")
    counts = _reader(spark, ("_first",), multiline).csv(named).groupBy(F.col("_metadata.file_path").alias("file_path")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(counts.withColumnRenamed("file_path", "_path"), _plain_path(F.col("file_path")) == _plain_path(F.col("_path")), "left") \
        .select("file_path", "file_name", "file_size", "file_modification_time", F.coalesce("rows", F.lit(0)).alias("rows")).orderBy("file_name")


def _plain_path(c: Column) -> Column:
    """One spelling of a path: listings say ``file:/x`` where rows say ``file:///x``."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), r"^file:/+", "file:/")


def file_headers(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file_path, columns): every file's header, read from its first block only."""
    return _listing(spark, csv_files(spark, path, glob, recursive=True)).select("file_path", "columns")


def header_drift(headers: DataFrame, expected: list[str]) -> DataFrame:
    """Per file: expected columns it lacks (error) and extra columns (kept, reported)."""
    exp = F.array(*[F.lit(c) for c in expected])
    return headers.select(
        "file_path",
        F.array_sort(F.array_except(exp, F.col("columns"))).alias("missing"),
        F.array_sort(F.array_except(F.col("columns"), exp)).alias("extra"),
        (F.col("columns") != exp).alias("reordered_or_changed"))


# The lattice of guessed types: a column's type is the join of its values' types.
# null < long < double < string, null < timestamp < string. A value sets one bit;
# bits are or-ed, so files and partitions merge in any order.
LONG, DOUBLE, TIMESTAMP, TEXT = 1, 2, 4, 8
_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


def _type_bit(c: Column) -> Column:
    number = c.try_cast("double")
    return F.when(c.isNull(), 0).when(c.try_cast("bigint").isNotNull() & c.rlike(r"^[+-]?\d+$"), LONG) \
        .when(number.isNotNull() & c.rlike(r"^[+-]?[0-9.]+([eE][+-]?\d+)?$"), DOUBLE) \
        .when(c.rlike(_TIME) & c.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP).otherwise(TEXT)


def _type_name(bits: Column) -> Column:
    return F.when(bits == 0, "null").when(bits == LONG, "bigint").when(bits <= LONG + DOUBLE, "double") \
        .when(bits == TIMESTAMP, "timestamp").otherwise("string")


def file_profile(spark: SparkSession, path: str, glob: str = "*.csv", null_tokens=NULL_TOKENS, multiline: bool = True,
                 recursive: bool = False) -> DataFrame:
    """One row per file and column: name, size, modification time, rows, position, column,
    guessed type, nulls. One pass over each group of files with equal headers; the
    type is that of all values, not of a sample. Files without rows have the type
    ``null`` in every column of their header."""
    files = csv_files(spark, path, glob, recursive)
    listed = _listing(spark, files).select("*", F.posexplode("columns").alias("position", "column")).drop("columns")
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        if f.header:
            groups.setdefault(f.header, []).append(f.path)
    facts = spark.createDataFrame([], "_path string, position int, rows bigint, bits int, nulls bigint")
    for header, paths in groups.items():
        raw = _reader(spark, header, multiline).csv(paths).select(
            F.col("_metadata.file_path").alias("_path"), *[_null_tokens(F.col(f"`{c}`"), null_tokens).alias(f"c{i}") for i, c in enumerate(header)])
        aggs = [a for i in range(len(header)) for a in (F.bit_or(_type_bit(F.col(f"c{i}"))).alias(f"b{i}"),
                                                        F.count_if(F.col(f"c{i}").isNull()).alias(f"n{i}"))]
        one = raw.groupBy("_path").agg(F.count(F.lit(1)).alias("rows"), *aggs)
        each = F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"b{i}").cast("int").alias("bits"), F.col(f"n{i}").alias("nulls"))
                                  for i in range(len(header))]))
        facts = facts.unionByName(one.select("_path", "rows", each))
    facts = facts.withColumnRenamed("position", "_position")
    joined = listed.join(facts, (_plain_path(F.col("file_path")) == _plain_path(F.col("_path"))) & (F.col("position") == F.col("_position")), "left")
    return joined.select("file_path", "file_name", "file_size", "file_modification_time", F.coalesce("rows", F.lit(0)).alias("rows"),
                         "position", "column", _type_name(F.coalesce("bits", F.lit(0))).alias("type"),
                         F.coalesce("nulls", F.lit(0)).alias("nulls"))


def incremental_scan(df: DataFrame, column: str, mark: str | None, lateness: str | None = None) -> DataFrame:
    """Rows strictly newer than ``mark`` (null timestamps drop out).

    On a typed timestamp column the comparison is pushed to the Parquet scan;
    on a text column the value is parsed first (malformed text raises under
    ANSI). ``lateness`` (an interval string) re-reads an overlap window so late
    rows are not lost; the idempotent load downstream absorbs the repeats.
    """
    if mark is None:
        return df
    dtype = dict(df.dtypes)[column]
    value = F.col(column) if dtype.startswith("timestamp") else parse_timestamp(column)
    bound = F.lit(mark).cast("timestamp_ntz")
    if lateness:
        bound = bound - F.expr(f"INTERVAL {lateness}")
    return df.filter(value > bound)


def lake_manifest(spark: SparkSession, path: str, max_keys: int | None = None) -> DataFrame:
    """Objects under a prefix (path, size, mtime) without reading their rows."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path)
             .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))
    files = files.orderBy("path")
    return files.limit(max_keys) if max_keys else files

