"""Benchmark decontamination by winnowing.

Both sides select fingerprints the same way: of the k-gram hashes in every
``window - k + 1`` consecutive k-grams (one window of words), all minimal ones.
Any shared span of ``window`` words therefore shares a selected fingerprint.
Documents and benchmark are joined on fingerprints, and each hit is extended
word by word to both sides; a match of at least ``window`` words is a hit span.
Items shorter than a window have no winnowing guarantee; each of them is one
window, looked up as a whole by its length and hash.

A bitmap of fixed size over the benchmark's fingerprints drops most document
fingerprints inside the scan; the join behind it is exact.

Defined cases: null or wordless documents have 0 words and no hit; wordless or
null items never occur; repeated rows are judged row by row; an item without
item_id contaminates but isn't listed; equal items are all listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.text import (ALNUM, LOWER, U64, blocks, bloom_bits, bloom_has, gram_hashes, keyed, mix64, saved, texts,
                               without, word_hashes, word_spans)

K = 5
WINDOW = 13


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is minimal in some run of ``width`` hashes."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    low = _sliding(grams, width, np.minimum)
    pad = np.zeros(width - 1, U64)
    most = _sliding(np.concatenate([pad, low, pad]), width, np.maximum)
    return np.flatnonzero(most == grams)


def _fp(kind: int, h: np.ndarray) -> np.ndarray:
    """Join key: the hash, mixed with the window length of short items."""
    return mix64(h ^ U64(kind)).view(np.int64)


FOUND = pa.struct([("kind", pa.int32()), ("fp", pa.int64()), ("pos", pa.int64()),
                   ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64()))])
FOUND_DDL = "array<struct<kind:int,fp:bigint,pos:bigint,left:array<bigint>,right:array<bigint>>>"


def _selected(h: np.ndarray, lo: int, hi: int, at: np.ndarray, k: int, window: int) -> list[tuple]:
    """Fingerprint rows of one document (words lo..hi of ``h``): position and the
    words to the left (nearest first) and right that a window could still hold."""
    reach, words, out = window - k, h.view(np.int64), []
    fps = _fp(window, gram_hashes_at(h, at, k))
    for p, fp in zip(at.tolist(), fps.tolist(), strict=True):
        out.append((window, fp, p - lo, words[max(lo, p - reach): p][::-1].tolist(),
                    words[p + k: min(hi, p + k + reach)].tolist()))
    return out


def gram_hashes_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    if not len(at):
        return np.zeros(0, U64)
    return np.array([gram_hashes(h[p: p + k], k)[0] for p in at.tolist()], U64)


def _hashed(data: np.ndarray, off: np.ndarray):
    data = LOWER[data]
    starts, ends, first = word_spans(data, off, ALNUM)
    return word_hashes(data, starts, ends), first


def benchmark_index(items: DataFrame, k: int, window: int) -> DataFrame:
    """(item_id, kind, fp, pos, left, right): winnowed fingerprints with their
    surroundings; ``kind`` is the window length, shorter for short items."""
    def run(it):
        for b in it:
            ids = b.column(0).to_pylist()
            for lo, _, data, off in blocks(b.column(1)):
                h, first = _hashed(data, off)
                rows = []
                for d in range(len(first) - 1):
                    a, z = int(first[d]), int(first[d + 1])
                    if z - a >= window:
                        at = winnow(gram_hashes(h[a:z], k), window - k + 1) + a
                        rows += [(ids[lo + d], *r) for r in _selected(h, a, z, at, k, window)]
                    elif z > a:
                        fp = int(_fp(z - a, gram_hashes(h[a:z], z - a))[0])
                        rows.append((ids[lo + d], z - a, fp, 0, [], []))
                cols = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["item_id", "kind", "fp", "pos", "left", "right"])
    return items.mapInArrow(run, "item_id long, kind int, fp long, pos long, left array<long>, right array<long>")


def candidates(docs: DataFrame, index: DataFrame, k: int, window: int) -> DataFrame:
    """One row per document: (row, doc_id, fp, n_words, found); ``found`` holds its
    fingerprints that may be in the benchmark. ``row`` is unique per row."""
    short = sorted(r.kind for r in index.where(F.col("kind") < window).select("kind").distinct().collect())
    seen = docs.sparkSession.sparkContext.broadcast(np.packbits(bloom_bits(index, "fp")))

    def run(it):
        bits = np.unpackbits(seen.value).astype(bool)
        nth = TaskContext.get().partitionId() << 40
        for b in it:
            ids, rows, n_words, found = b.column(0), [], [], []
            for _, _, data, off in blocks(b.column(2)):
                h, first = _hashed(data, off)
                sizes = np.diff(first)
                per_doc: dict[int, list[tuple]] = {}
                grams = gram_hashes(h, k)
                at = winnow(grams, window - k + 1) if len(grams) else np.zeros(0, np.int64)
                at = at[bloom_has(bits, _fp(window, grams[at]))]
                doc = np.searchsorted(first, at, "right") - 1
                ok = at + k <= first[doc + 1]
                at, doc = at[ok], doc[ok]
                for d in np.unique(doc).tolist():
                    per_doc[d] = _selected(h, int(first[d]), int(first[d + 1]), at[doc == d], k, window)
                for n in short:
                    g = gram_hashes(h, n)
                    fps = _fp(n, g)
                    at = np.flatnonzero(bloom_has(bits, fps))
                    doc = np.searchsorted(first, at, "right") - 1
                    ok = at + n <= first[doc + 1]
                    for p, d in zip(at[ok].tolist(), doc[ok].tolist(), strict=True):
                        per_doc.setdefault(d, []).append((n, int(fps[p]), p - int(first[d]), [], []))
                n_words += sizes.tolist()
                found += [[dict(zip(("kind", "fp", "pos", "left", "right"), r, strict=True)) for r in per_doc.get(d, [])]
                          for d in range(len(sizes))]
            rows = list(range(nth, nth + len(n_words)))
            nth += len(n_words)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), ids, b.column(1), pa.array(n_words, pa.int64()),
                                              pa.array(found, pa.list_(FOUND))], ["row", "doc_id", "fp", "n_words", "found"])

    return docs.select("doc_id", "fp", "text").mapInArrow(run, f"row long, doc_id long, fp long, n_words long, found {FOUND_DDL}")


def _same_run(x: str, y: str) -> Column:
    """Number of leading equal words of two arrays."""
    eq = F.zip_with(x, y, lambda a, b: F.coalesce(a == b, F.lit(False)))
    miss = F.array_position(eq, F.lit(False))
    return F.when(miss == 0, F.size(eq)).otherwise(miss - 1)


def hit_spans(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", k: int = K, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every document row (row, doc_id, fp, n_words), and the matched
    word spans (row, begin, end, item_id)."""
    items = texts(benchmark, item_col, text_col).withColumnRenamed("doc_id", "item_id")
    index = saved(benchmark_index(items, k, window), "bench")
    rows = saved(candidates(keyed(df, id_col, text_col), index, k, window), "decon")
    found = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.*")
    other = index.select("kind", "fp", "item_id", F.col("left").alias("ileft"), F.col("right").alias("iright")).distinct()
    spans = found.join(other, ["kind", "fp"]) \
        .withColumn("l", _same_run("left", "ileft")).withColumn("r", _same_run("right", "iright")) \
        .withColumn("len", F.when(F.col("kind") == window, F.col("l") + F.col("r") + k).otherwise(F.col("kind"))) \
        .where(F.col("len") >= F.col("kind")) \
        .select("row", (F.col("pos") - F.col("l")).alias("begin"), (F.col("pos") - F.col("l") + F.col("len")).alias("end"),
                "item_id").distinct()
    return rows.select("row", "doc_id", "fp", "n_words"), spans


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", share: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, fp) of every row;
    contaminated: a hit, and ``share`` times the hit words reach all words."""
    rows, spans = hit_spans(df, benchmark, id_col, text_col, item_col)
    spans = saved(spans, "spans")
    order = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    words = spans.select("row", "begin", "end").distinct() \
        .withColumn("reached", F.coalesce(F.max("end").over(order), F.lit(0).cast("long"))) \
        .groupBy("row").agg(F.sum(F.greatest(F.lit(0).cast("long"), F.col("end") - F.greatest("begin", "reached"))).alias("n_hit"))
    names = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    return rows.join(words, "row", "left").join(names, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) * share >= F.greatest(F.col("n_words"), F.lit(1))).alias("contaminated"), "fp")


def drop_contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``df`` without its contaminated rows; all columns stay."""
    return without(df, contamination(df, benchmark).where("contaminated"))
