"""Order MinHash fingerprints, sensitive to edit distance.

A text's code-point k-mers are numbered by occurrence, so that (k-mer, 2nd
time) differs from (k-mer, 1st time). Hash space is cut into ``sketches`` equal
bins (one permutation split into bins instead of one hash pass per sketch). In
every bin the ``picks`` minimal hashes are selected, put back into text order,
and hashed as a tuple. Moving, inserting or deleting text changes k-mers,
occurrence numbers or their order, so the share of equal tuples falls with the
edit distance.

Likeness of two fingerprints: equal tuples over bins that are filled in at
least one of them; 1.0 when both are empty.

Defined cases: null text = empty text; empty text has an all-zero fingerprint;
a text shorter than ``k`` is one padded k-mer; texts of any length are read
whole; rows are never merged, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import GOLDEN, U64, M1, M2, mix64, texts

K = 8  # code points in a k-mer (a power of two)
SKETCHES = 64
PICKS = 2
_POS_BITS = U64(24)
_POS_MASK = U64((1 << 24) - 1)
_FULL = U64(0xFFFFFFFFFFFFFFFF)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """Mixed 64-bit hash of every k-mer, by doubling."""
    if len(codes) < k:
        codes = np.concatenate([codes, np.full(k - len(codes), 0x110000, "<u4")])
    h, power, width = (codes.astype(U64) + U64(1)) * GOLDEN, M1, 1
    while width < k:
        left = h[:-width] * power
        left += h[width:]
        h, power, width = left, power * power, width * 2
    h ^= h >> U64(32)
    h *= M2
    h ^= h >> U64(29)
    h *= M1
    return h


def _first_per_bin(ordered: np.ndarray, sketches: int, picks: int) -> np.ndarray:
    edges = np.arange(sketches, dtype=U64) << U64(64 - (sketches - 1).bit_length())
    at = np.searchsorted(ordered, edges)
    end = np.append(at[1:], len(ordered))
    idx = at[:, None] + np.arange(picks)
    return np.where(idx < end[:, None], np.append(ordered, _FULL)[np.minimum(idx, len(ordered))], _FULL)


def signature(codes: np.ndarray, k: int = K, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """Fingerprint of one text as ``sketches`` 32-bit values (0: empty bin)."""
    if not len(codes):
        return np.zeros(sketches, np.uint32)
    with np.errstate(over="ignore"):
        h = _kmers(codes, k)
        pos = np.arange(len(h), dtype=U64)
        shift = max(0, int(len(h) - 1).bit_length() - 24)
        h &= ~_POS_MASK
        h |= pos >> U64(shift)  # hash above, text position below: one sort gives both
        h.sort()
        key = h >> _POS_BITS
        again = np.empty(len(h), bool)
        again[0] = False
        np.equal(key[1:], key[:-1], out=again[1:])
        picked = _first_per_bin(h[~again] if again.any() else h, sketches, picks)
        rep = np.flatnonzero(again)
        if len(rep):
            begin = np.flatnonzero(~again)
            nth = rep - begin[np.searchsorted(begin, rep, "right") - 1]
            more = mix64(key[rep] + nth.astype(U64) * GOLDEN)
            more = (more & ~_POS_MASK) | (h[rep] & _POS_MASK)
            more.sort()
            picked = np.concatenate([picked, _first_per_bin(more, sketches, picks)], axis=1)
            picked.sort(axis=1)
            picked = picked[:, :picks]
        filled = picked != _FULL
        place = np.where(filled, picked & _POS_MASK, _FULL)
        picked = np.take_along_axis(picked, np.argsort(place, axis=1, kind="stable"), axis=1)
        acc = np.zeros(sketches, U64)
        for j in range(picks):
            one = picked[:, j]
            acc = mix64(acc * M1 + np.where(one != _FULL, (one >> _POS_BITS) + U64(1), U64(0)))
    return np.where(filled.any(axis=1), np.maximum(acc >> U64(32), U64(1)), U64(0)).astype(np.uint32)


def to_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    either = (a | b) != 0
    n = int(either.sum())
    return float(((a == b) & either).sum() / n) if n else 1.0


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``df``."""
    def run(it):
        for b in it:
            out = [to_hex(signature(codes_of(t or ""), k, sketches, picks)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])
    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


# --- neighbours in id order -------------------------------------------------

def _block_of(x: Column, cuts: list[float]) -> Column:
    """Number of cut points not above ``x``, as a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x >= F.lit(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(cuts))


def with_successors(df: DataFrame, blocks: int) -> DataFrame:
    """Rows cut into at most ``blocks`` ranges of doc_id; every range also gets
    the first row of the next range (``tail``), the last one that of the first.

    Cut points are ``blocks - 1`` quantiles and the range heads ``blocks`` ids;
    nothing else reaches the driver. Rows without doc_id get blocks of their own
    (negative) and no successor.
    """
    spark = df.sparkSession
    ids = df.select("doc_id").where(F.col("doc_id").isNotNull())
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.25 / blocks)))
    block = _block_of(F.col("doc_id").cast("double"), cuts)
    heads = sorted((r.block, r.head) for r in
                   ids.groupBy(block.alias("block")).agg(F.min("doc_id").alias("head")).collect())
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(blocks))
    rows = df.withColumn("block", F.when(F.col("doc_id").isNull(), spread).otherwise(block).cast("int")) \
        .withColumn("tail", F.lit(False))
    if not heads:
        return rows
    follow = [(heads[i][0], heads[(i + 1) % len(heads)][1]) for i in range(len(heads))]
    follow_df = spark.createDataFrame(follow, "block int, doc_id long")  # at most `blocks` rows
    tails = df.join(F.broadcast(follow_df), "doc_id").select("doc_id", "text", "block", F.lit(True).alias("tail"))
    return rows.select("doc_id", "text", "block", "tail").unionByName(tails)


EDIT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None,
                  k: int = K, sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """Fingerprint every text and its edited text (the last quarter replaced by
    the start of the next document in ascending doc_id, after the last the
    first), and compare it with the edited text and with the next document.

    Texts move once, by id range. Equal ids are ordered by text (null first). A
    row without doc_id has no successor: its edited text is its own text and
    ``near_next`` is null. A single row is its own successor.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_successors(texts(df, id_col, text_col), blocks or 4 * parts)
    rows = rows.repartition(parts, "block").sortWithinPartitions("block", "tail", "doc_id", "text")

    def finish(row, nxt):
        doc_id, text, codes, sig = row
        n = len(codes)
        if nxt is None:
            edited, near_next = text, None
            esig = sig
        else:
            q = n // 4
            edited, near_next = text[: n - q] + nxt[1][:q], likeness(sig, nxt[3])
            esig = signature(np.concatenate([codes[: n - q], nxt[2][:q]]), k, sketches, picks) if q else sig
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, n, sha, to_hex(sig), to_hex(esig), likeness(sig, esig), near_next

    def run(it) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        pending, at = None, None
        for b in it:
            out = []
            for doc_id, text, block, tail in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != at:
                    pending, at = None, block
                elif tail and pending is None:
                    continue  # equal ids at a range's start: only the first is the successor
                text = text or ""
                codes = codes_of(text)
                row = (doc_id, text, codes, signature(codes, k, sketches, picks))
                if doc_id is None:
                    out.append(finish(row, None))
                    continue
                if pending is not None:
                    out.append(finish(pending, row))
                pending = None if tail else row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(run, EDIT_SCHEMA)
