"""Vectorised helpers over Arrow text columns, shared by this package.

Tasks receive Arrow batches; these helpers turn a text column into flat numpy
arrays (bytes, word spans, 64-bit word hashes) so that per-word work never runs
as Python bytecode. Whole texts are always covered; blocks only bound memory.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import checkpoint_dir, read_table

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
M1, M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= M1
    x ^= x >> U64(27)
    x *= M2
    x ^= x >> U64(31)
    return x


BYTE_KEYS = mix64(np.arange(1, 257, dtype=U64) * GOLDEN)
POS_KEYS = mix64(np.arange(1, 4097, dtype=U64) * M1) | U64(1)
WORD_KEYS = mix64(np.arange(1, 65, dtype=U64) * M2) | U64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: words [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of ASCII-lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def blocks(col: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive whole documents of about ``max_bytes`` (a longer one alone):
    (first row, end row, bytes, offsets)."""
    data, off = column_bytes(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
        yield lo, hi, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray,
               cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each document's first word
    (``first[d]:first[d+1]`` are the words of document d). No word crosses a
    document boundary; ``cut[i]`` also ends a word between bytes i and i+1."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = is_word[data]
    begin, last = w.copy(), w.copy()
    if cut is None:
        begin[1:] &= ~w[:-1]
        last[:-1] &= ~w[1:]
    else:
        begin[1:] &= ~w[:-1] | cut
        last[:-1] &= ~w[1:] | cut
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begin[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes (multilinear in byte and position, mixed)."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    at = np.cumsum(lens) - lens
    pos = np.arange(int(at[-1] + lens[-1])) - np.repeat(at, lens)
    v = BYTE_KEYS[data[pos + np.repeat(starts, lens)]]
    v *= POS_KEYS[pos & 4095]
    if lens.max() > 4096:
        v *= mix64((pos >> 12).astype(U64)) | U64(1)
    return mix64(np.add.reduceat(v, at) ^ (lens.astype(U64) * GOLDEN))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (position i: words i..i+n-1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = h[:m] * WORD_KEYS[0]
    for j in range(1, n):
        out += h[j: j + m] * WORD_KEYS[j % 64]
    return mix64(out + U64(n))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names (extra columns can't clash)."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, hash of the text (``fp``) and text; id and hash tell rows apart."""
    return texts(df, id_col, text_col).withColumn("fp", F.xxhash64("text"))


def without(df: DataFrame, rejected: DataFrame) -> DataFrame:
    """``df`` without the rows whose (doc_id, fp) is in ``rejected``; all columns stay."""
    bad = rejected.select(F.col("doc_id").alias("_bad_id"), F.col("fp").alias("_bad_fp")).distinct()
    return df.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("text") == F.col("_bad_fp")), "left_anti")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path (full URI) under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex[:12]}"


#: shuffle files of a query go when it ends, not when the driver next collects its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str, paths: list[str] | None = None) -> DataFrame:
    """Write to the shared folder and read back: work is done once, the lineage
    is cut, and the result survives the loss of any executor. The shuffle files
    of the write are released with it. ``paths`` gets the new path, for ``removed``."""
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Delete what ``saved`` wrote to ``paths``, and empty the list: only once all that
    reads it is saved itself."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    paths.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- fixed-size summaries ---------------------------------------------------

PARTS = 256
PART_SCHEMA, PART_DDL = pa.schema([("part", pa.int32()), ("raw", pa.binary())]), "part int, raw binary"


def in_parts(state: np.ndarray) -> pa.RecordBatch:
    """A task's summary (rows x slots) as compressed rows, one for each of ``PARTS``
    ranges of slots; ranges of zeros are left out."""
    cuts = [(i, c) for i, c in enumerate(np.split(state, PARTS, axis=1)) if c.any()]
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in cuts], pa.int32()),
                                       pa.array([zlib.compress(c.tobytes(), 1) for _, c in cuts], pa.binary())],
                                      schema=PART_SCHEMA)


def merged(rows: DataFrame, state: np.ndarray, add) -> np.ndarray:
    """The summaries of all tasks in one, written into ``state`` (zeros). Equal ranges
    of slots meet by a shuffle, so that neither the tasks that make summaries nor
    those that merge them are few; ``add(total, more)`` merges in place. The driver
    gets ``state`` once, whatever the table's size."""
    shape, dtype = (state.shape[0], state.shape[1] // PARTS), state.dtype

    def opened(raw: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(raw), dtype).reshape(shape)

    def run(it):
        total: dict[int, np.ndarray] = {}
        for b in it:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if part in total:
                    add(total[part], opened(raw.as_py()))
                else:
                    total[part] = opened(raw.as_py()).copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([zlib.compress(t.tobytes(), 1) for t in total.values()], pa.binary())],
                                         schema=PART_SCHEMA)

    for r in rows.repartition("part").mapInArrow(run, PART_DDL).collect():  # at most PARTS rows, together of fixed size
        state[:, r.part * shape[1]: (r.part + 1) * shape[1]] = opened(r.raw)
    return state


BLOOM_BITS = 1 << 24


def _either(total: np.ndarray, more: np.ndarray) -> None:
    total |= more


def bloom_bits(df: DataFrame, col: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """Bitmap of fixed size (``bits``/8 bytes) of a long column, built in the
    tasks and combined there; only the one bitmap reaches the driver. Used as a
    prefilter in front of an exact join, never instead of it."""
    def mark(it):
        seen = np.zeros(bits, dtype=bool)
        for b in it:
            x = b.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            for s in bloom_slots(x, bits):
                seen[s] = True
        yield in_parts(np.packbits(seen)[None, :])

    total = merged(df.select(col).mapInArrow(mark, PART_DDL), np.zeros((1, bits // 8), np.uint8), _either)
    return np.unpackbits(total[0]).astype(bool)


def bloom_slots(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(x.astype(np.int64).view(U64) + GOLDEN)
    return (h & U64(bits - 1)).astype(np.int64), ((h >> U64(32)) & U64(bits - 1)).astype(np.int64)


def bloom_has(seen: np.ndarray, x: np.ndarray) -> np.ndarray:
    a, b = bloom_slots(x, len(seen))
    hit = seen[a]
    idx = np.flatnonzero(hit)
    hit[idx] = seen[b[idx]]
    return hit


ASK_DDL = "block long, part int, raw binary"
PART_VALUES = 1 << 22  # values that one part compares at most, about


def _asked(x: np.ndarray, parts: int) -> np.ndarray:
    """Part and remainder of each value's hash, as one key: the part in the upper 32 bits."""
    h = mix64(x.astype(np.int64).view(U64) + M2)
    return ((h & U64(0xFFFFFFFF)) % U64(parts) << U64(32)) | (h >> U64(32))


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(parts + 1, dtype=U64) << U64(32))


def may_repeat(x: np.ndarray, parts: int, answers: dict[int, bytes]) -> np.ndarray:
    """Of the values of a block, those that are in it twice or in another block, by
    the answers of ``repeat_answers``."""
    keys, back, n = np.unique(_asked(x, parts), return_inverse=True, return_counts=True)
    cuts = _cuts(keys, parts)
    again = n > 1
    for part, raw in answers.items():
        lo, hi = cuts[part], cuts[part + 1]
        again[lo:hi] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=hi - lo).astype(bool)
    return again[back]


def repeat_answers(blocks: DataFrame, col: str, parts: int) -> DataFrame:
    """(block, part, raw): for the values of ``col`` (array<long>) in a row of
    ``blocks`` (block, col), a bit each that tells whether another block may have the
    value: no repeated value is missed, and at most about one in 2^32 / ``PART_VALUES``
    single ones passes. Remainders of four bytes meet in hash parts, whose number
    follows the table, so neither a task nor the driver holds the values of all."""
    def ask(it):
        for b in it:
            for block, values in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                keys = np.unique(_asked(values.values.to_numpy(zero_copy_only=False), parts))
                cuts = _cuts(keys, parts)
                rest = keys.astype(np.uint32)
                own = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(own), pa.int64()), pa.array(own, pa.int32()), pa.array(
                    [rest[cuts[i]: cuts[i + 1]].tobytes() for i in own], pa.binary())], ["block", "part", "raw"])

    def answer(it):
        asked: dict[int, list[tuple[int, np.ndarray]]] = {}
        for b in it:
            for block, part, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                asked.setdefault(part, []).append((block, np.frombuffer(raw, np.uint32)))
        for part in list(asked):
            rows = asked.pop(part)
            every = np.sort(np.concatenate([x for _, x in rows]))
            again = np.append(np.unique(every[1:][every[1:] == every[:-1]]), np.uint32(0))
            bits = [np.packbits(again[np.searchsorted(again[:-1], x)] == x if len(again) > 1 else np.zeros(len(x), bool)).tobytes()
                    for _, x in rows]
            yield pa.RecordBatch.from_arrays([pa.array([block for block, _ in rows], pa.int64()), pa.array([part] * len(rows), pa.int32()),
                                              pa.array(bits, pa.binary())], ["block", "part", "raw"])

    return blocks.select("block", col).mapInArrow(ask, ASK_DDL).repartition("part").mapInArrow(answer, ASK_DDL)
