"""Probabilistic suffix tree language model over the bytes of normalised text.

A text's tokens are its ASCII-lower-cased words and one end token. Spelled out
(words, a space between two, a line feed as the end) the bytes determine the
tokens and the other way round, so the product of the bytes' probabilities is
the probability of the token sequence, on the same footing as the unigram base.

Training counts every context of up to ``DEPTH`` bytes with its next byte over
all training documents. Contexts seen at least ``MIN_COUNT`` times, whatever the
corpus' size, are candidates. A candidate stays when its next-byte distribution
diverges from the one of its suffix (Kullback-Leibler, in bits, weighted by its
count against the cost of storing it), or when a longer context that ends in it
stays; candidates of up to three bytes always stay. Distributions are smoothed
towards the suffix's (Witten-Bell, at the root towards uniform bytes). A byte is
scored by its longest retained context.

The tree grows with the corpus and is never gathered: it lives in hash buckets of
the three nearest bytes, where a context meets its suffixes of three bytes and
more. Frequent contexts of three bytes (``dense_contexts``) are dealt out by the
fourth byte as well; their own counts are broadcast, at most 256 numbers for each of
at most 1 / ``DENSE_SHARE`` of them. A chunk of documents asks for its distinct (context, byte) keys with their
training counts; a bucket adds the counts up, builds its part of the tree and
answers with log probabilities, which go back to the chunk. Only counts of byte
triples (at most 2^24) are broadcast besides, for the contexts of up to two bytes.

The base needs every word's corpus count, which is asked for in the same way.

Defined cases: null text = empty, whose only token is the end; a null doc_id is
trained on and not held out; repeated rows count and are scored each; with no
training token the base and the model are uniform.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import LOWER, SPACED, U64, blocks, mix64, saved, word_hashes, word_spans

DEPTH = 7  # with the next byte, a key fills 64 bits
MIN_COUNT = 8
KEPT = 3  # contexts of up to so many bytes stay without a divergence test
GAIN_BITS = 6.0  # a context must save this many bits per next byte that it stores
CHUNK = 20 << 20
HELD_KEYS = 1_500_000  # keys that wait before they are merged
SHORT_BUCKETS = 8
END = 0x0A


def held_out(folds: int = 7, rest: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == rest, F.lit(False))


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """Bytes of the normalised documents, each with DEPTH line feeds in front and
    one at its end; (bytes, offset of each document's first own byte, its end)."""
    docs = len(first) - 1
    words = np.diff(first)
    sizes = ends - starts + 1
    upto = np.concatenate([[0], np.cumsum(sizes)])
    own = upto[first[1:]] - upto[first[:-1]] + (words == 0)  # an empty document is its end alone
    doc_end = np.cumsum(own + DEPTH)
    doc_begin = doc_end - own
    out = np.full(int(doc_end[-1]) if docs else 0, END, np.uint8)
    if len(starts):
        doc = np.repeat(np.arange(docs), words)
        to = doc_begin[doc] + upto[:-1] - upto[first[doc]]
        n = ends - starts
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to, n) + step] = data[np.repeat(starts, n) + step]
        inner = np.ones(len(starts), bool)
        inner[first[1:][words > 0] - 1] = False
        out[(to + n)[inner]] = 0x20
    return out, doc_begin, doc_end


def context_keys(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(previous byte, the one before, ..., DEPTH-th before, zeros, own byte) from the top down."""
    pad = np.concatenate([np.zeros(7, np.uint8), text])
    view = np.lib.stride_tricks.as_strided(pad, (len(text), 8), (1, 1)).view("<u8")[:, 0] if len(text) else np.zeros(0, "<u8")
    v = view[at].astype(U64)
    own = v >> U64(56)
    unused = U64(8 * (8 - DEPTH))
    return ((v << U64(8)) >> unused << unused) | own


def _sum_by_key(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[new], np.add.reduceat(c, new) if len(new) else c


class Grams:
    """Counts of keys, merged now and then so that memory follows the distinct keys.
    Keys that are not counted are kept with count 0."""

    def __init__(self):
        self.held, self.keys, self.counts, self.waiting = None, [], [], 0

    def add(self, keys: np.ndarray, counted: bool = True) -> None:
        k, c = np.unique(keys, return_counts=True)
        self.put(k, (c * counted).astype(np.int32))

    def put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > HELD_KEYS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.keys:
            k, c = _sum_by_key(self.keys, self.counts)
            c = c.astype(self.counts[0].dtype)  # a chunk's counts fit 32 bits, the corpus' are put with 64
            self.keys, self.counts, self.waiting = [], [], 0
            if self.held is None or not len(self.held[0]):
                self.held = k, c
            else:
                keys, counts = self.held
                at = np.searchsorted(keys, k)
                old = keys[np.minimum(at, len(keys) - 1)] == k
                counts[at[old]] += c[old]
                self.held = np.insert(keys, at[~old], k[~old]), np.insert(counts, at[~old], c[~old])
        return self.held or (np.zeros(0, U64), np.zeros(0, np.int64))


class Distinct:
    """Distinct keys, merged now and then."""

    def __init__(self):
        self.keys, self.waiting = [], 0

    def add(self, keys: np.ndarray) -> None:
        self.keys.append(_distinct(keys))
        self.waiting += len(self.keys[-1])
        if self.waiting > HELD_KEYS:
            self.merge()

    def merge(self) -> np.ndarray:
        k = np.concatenate([np.zeros(0, U64), *self.keys])
        self.keys.clear()
        k.sort(kind="stable")  # merges ascending runs
        self.keys, self.waiting = [_unrepeated(k)], 0
        return self.keys[0]


def _distinct(keys: np.ndarray) -> np.ndarray:
    return _unrepeated(np.sort(keys))


def _unrepeated(k: np.ndarray) -> np.ndarray:
    return k[np.concatenate([[True], k[1:] != k[:-1]])] if len(k) else k


READ = ("kind int, chunk long, bucket int, doc_id long, held_out boolean, n_tokens long, symbols long, "
        "keys binary, counts binary")
_READ = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int32()), ("doc_id", pa.int64()),
                   ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("symbols", pa.int64()),
                   ("keys", pa.binary()), ("counts", pa.binary())])
DOC, WORDS, GRAMS, SHORT, TEXT, DENSE = 0, 1, 2, 3, 4, 5


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_READ)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _READ.types, strict=True)], schema=_READ)


def _pack_planes(x: np.ndarray) -> bytes:
    """Values byte by byte, which leaves like bytes side by side."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 3)


def _unpack_planes(raw: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind)[:, 0] if flat.size else np.zeros(0, kind)


def _pack_keys(k: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte: most of those bytes are zero."""
    d = np.diff(k, prepend=U64(0))
    return zstandard.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def _unpack_keys(raw: bytes) -> np.ndarray:
    d = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(d.T).view(U64)[:, 0], dtype=U64)


def gram_buckets(keys: np.ndarray, buckets: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ascending keys ordered by bucket, and each bucket's bounds in that
    order. A bucket is a hash of the three nearest bytes, of ``dense`` ones with the fourth."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(buckets + 1, np.int64)
    near = keys >> U64(40)
    if len(dense):
        split = _among(dense)[near.view(np.int64)]
        near[split] = keys[split] >> U64(32) | U64(1 << 32)
        del split
    new = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
    of = ((mix64(near[new]) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int16 if buckets < 1 << 15 else np.int32)
    of = np.repeat(of, np.diff(np.append(new, len(keys))))
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(buckets + 1))


def _among(dense: np.ndarray) -> np.ndarray:
    """By context of three bytes: is it dense?"""
    out = np.zeros(1 << 24, bool)
    out[dense.astype(np.int64)] = True
    return out


def read_corpus(docs: DataFrame, buckets: int, dense: np.ndarray) -> DataFrame:
    """One pass over (doc_id, held_out, text). Rows by kind: DOC (a document, by its
    place in the chunk), TEXT (spelled documents, some at a time), WORDS and GRAMS
    (a chunk's distinct word hashes and context keys with training counts, by
    bucket), SHORT (a chunk's training counts of byte triples), DENSE (those of the
    dense contexts of three bytes with their next byte)."""
    def run(it):
        part = TaskContext.get().partitionId()
        nth, frequent, pack = 0, _among(dense), zstandard.ZstdCompressor(level=3)
        for b in it:
            ids, held = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in blocks(b.column(2), CHUNK):
                chunk, nth = (part << 32) | nth, nth + 1
                words, grams, triples, quads = Grams(), Grams(), Grams(), Grams()
                for i, a in enumerate(_sub_blocks(off)):
                    piece = LOWER[data[off[a[0]]: off[a[1]]]]
                    starts, ends, first = word_spans(piece, off[a[0]: a[1] + 1] - off[a[0]], SPACED)
                    hashes = word_hashes(piece, starts, ends)
                    text, begin, end = spelled(piece, starts, ends, first)
                    test = held[lo + a[0]: lo + a[1]]
                    keys = context_keys(text, own_bytes(begin, end))
                    in_train = np.repeat(~test, end - begin), np.repeat(~test, np.diff(first))
                    for sums, x, train in ((grams, keys, in_train[0]), (words, hashes, in_train[1])):
                        sums.add(x[train])
                        sums.add(x[~train], counted=False)
                    keys = keys[in_train[0]]
                    triples.add(shorter_keys(keys, 2).astype(np.uint32))
                    often = keys[frequent[(keys >> U64(40)).astype(np.int64)]]
                    quads.add(shorter_keys(often, 3).astype(np.uint32))
                    sizes, symbols = np.diff(first) + 1, end - begin
                    yield _batch([(TEXT, chunk, i, None, None, None, None, pack.compress(text.tobytes()), None)])
                    yield _batch([(DOC, chunk, a[0] + d, ids[lo + a[0] + d], bool(test[d]), int(sizes[d]), int(symbols[d]), None, None)
                                  for d in range(a[1] - a[0])])
                uniq, count = words.merge()
                cut = np.searchsorted(uniq, _bounds(buckets))
                yield _batch([(WORDS, chunk, i, None, None, None, None, _pack_keys(uniq[x:y]), _pack_planes(count[x:y]))
                              for i, (x, y) in enumerate(zip(cut, np.append(cut[1:], len(uniq)), strict=True)) if y > x])
                keys, count = grams.merge()
                order, cut = gram_buckets(keys, buckets, dense)
                for i in range(buckets):
                    rows = order[cut[i]: cut[i + 1]]
                    if len(rows):
                        yield _batch([(GRAMS, chunk, i, None, None, None, None, _pack_keys(keys[rows]), _pack_planes(count[rows]))])
                for kind, sums in ((SHORT, triples), (DENSE, quads)):
                    keys, count = sums.merge()
                    keys = keys.astype(U64)
                    for i in range(SHORT_BUCKETS):
                        rows = (keys >> U64(16)) % U64(SHORT_BUCKETS) == i
                        if rows.any():
                            yield _batch([(kind, chunk, i, None, None, None, None, _pack_keys(keys[rows]),
                                           _pack_planes(count[rows].astype(np.int64)))])
    return docs.select("doc_id", "held_out", "text").mapInArrow(run, READ)


def own_bytes(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions of all documents' own bytes in their spelled text."""
    n = end - begin
    return np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)


#: contexts of three bytes that hold more than this share of a sample's bytes are dense:
#: at most 1/share of them, so what is broadcast about them has a bound
DENSE_SHARE, DENSE_SAMPLE, DENSE_STRETCH = 1e-3, 2_000, 4_000


def dense_contexts(docs: DataFrame) -> np.ndarray:
    """Frequent contexts of three bytes in a bounded sample, ascending: ``DENSE_SAMPLE``
    documents, of each a stretch of ``DENSE_STRETCH`` characters at a place from its hash.
    Only the dealing of contexts to buckets follows from them, never a result."""
    spot = F.xxhash64("doc_id", "text")
    place = F.pmod(F.shiftright("spot", 20), F.greatest(F.length("text") - DENSE_STRETCH, F.lit(0)) + 1) + 1
    few = 4.0 * DENSE_SAMPLE * (1 << 20) / max(1, docs.count())  # a hash threshold in front of the sort
    some = docs.where(F.col("text").isNotNull()).withColumn("spot", spot).where(F.pmod("spot", F.lit(1 << 20)) <= few) \
        .select("spot", F.substring("text", place.cast("int"), F.lit(DENSE_STRETCH)).alias("text")) \
        .orderBy(F.pmod("spot", F.lit(1 << 20)), "spot").limit(DENSE_SAMPLE).toArrow()
    total = Grams()
    for _, _, data, off in blocks(some.column("text")):
        data = LOWER[data]
        text, begin, end = spelled(data, *word_spans(data, off, SPACED))
        keys = context_keys(text, own_bytes(begin, end)) >> U64(40)
        total.add(keys)
    keys, counts = total.merge()
    return keys[counts > DENSE_SHARE * counts.sum()]


def shorter_keys(keys: np.ndarray, depth: int, whole: int = 7) -> np.ndarray:
    """(nearest ``depth`` bytes, own byte) of keys with ``whole`` context bytes."""
    return (keys >> U64(8 * (whole - depth + 1)) << U64(8)) | (keys & U64(255))


def _sub_blocks(off: np.ndarray, size: int = 1 << 19):
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def _bounds(buckets: int) -> np.ndarray:
    return np.array([(i << 64) // buckets for i in range(buckets)], U64)


def word_answers(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """(answers, N, V): per chunk and bucket the corpus counts of the requested
    words, in the order asked; all training tokens; distinct training words.

    A bucket holds each word once per chunk, whatever its frequency."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("counts", pa.binary()), ("words", pa.int64())])

    def answer(table: pa.Table) -> pa.Table:
        keys = [_unpack_keys(x) for x in table.column("keys").to_pylist()]
        counts = [_unpack_planes(x, np.int32).astype(np.int64) for x in table.column("counts").to_pylist()]
        all_keys, all_counts = _sum_by_key(keys, counts)
        known = int((all_counts > 0).sum())
        out = [_pack_planes(all_counts[np.searchsorted(all_keys, k)]) for k in keys]
        return pa.table([table.column("chunk"), table.column("bucket"), pa.array(out, pa.binary()),
                         pa.array([known] + [0] * (len(out) - 1), pa.int64())], schema=schema)

    answers = saved(rows.where(F.col("kind") == WORDS).select("chunk", "bucket", "keys", "counts")
                    .groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, counts binary, words long"), "answers")
    n = rows.where((F.col("kind") == DOC) & ~F.col("held_out")).agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    ends = n[1] or 0
    return answers, int(n[0] or 0), int(answers.agg(F.sum("words")).first()[0] or 0) + (ends > 0)


# --- the partitioned tree ---------------------------------------------------

class Short:
    """Contexts of up to two bytes, from the training counts of (two nearest bytes,
    next byte): at most 2^24 of them, at any input size; and those of the dense
    contexts of three bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, dense: np.ndarray, dense_keys: np.ndarray, dense_counts: np.ndarray):
        self.dense, self.dense_keys, self.dense_counts = dense, dense_keys, dense_counts
        self.keys, self.counts = keys, counts
        near, own = (keys >> U64(16)).astype(np.int64), (keys & U64(255)).astype(np.int64)
        one = np.bincount(near * 256 + own, counts, minlength=1 << 16).reshape(256, 256)
        root = (one.sum(axis=0) + 1) / (one.sum() + 256)
        self.p = _smoothed(one, one.sum(axis=1, keepdims=True), (one > 0).sum(axis=1, keepdims=True), root[None, :])
        two = (keys >> U64(8)).astype(np.int64)
        self.n, self.kinds = np.bincount(two, counts, minlength=1 << 16), np.bincount(two, minlength=1 << 16)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Probability of each (two nearest bytes, next byte)."""
        two, own = (keys >> U64(8)).astype(np.int64), (keys & U64(255)).astype(np.int64)
        count = np.zeros(len(keys))
        if len(self.keys):
            i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            count = np.where(self.keys[i] == keys, self.counts[i], 0)
        return _smoothed(count, self.n[two], self.kinds[two], self.p[two >> 8, own])


    def whole(self, entry: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corpus-wide (count, n, kinds) of each (three nearest bytes, next byte) of a bucket.
        ``count``: in the bucket; of dense contexts other buckets hold the rest."""
        ctx = entry >> U64(8)
        new = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
        size = np.diff(np.append(new, len(ctx)))
        n, kinds = np.repeat(np.add.reduceat(count, new), size), np.repeat(np.add.reduceat((count > 0).astype(np.int64), new), size)
        split = np.isin(ctx, self.dense)
        if split.any():
            at, known = _found(self.dense_keys, entry[split])
            count = count.copy()
            count[split] = np.where(known, self.dense_counts[at], 0) if len(self.dense_keys) else 0
            own = self.dense_keys >> U64(8)
            low, high = (np.searchsorted(own, ctx[split], side) for side in ("left", "right"))
            upto = np.concatenate([[0], np.cumsum(self.dense_counts)])
            n[split], kinds[split] = upto[high] - upto[low], high - low
        return count, n, kinds


def _found(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each asked key among ascending ``keys``, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, asked), max(0, len(keys) - 1))
    return at, (keys[at] == asked) if len(keys) else np.zeros(len(asked), bool)


def _smoothed(count, n, kinds, base):
    """Towards the suffix's distribution; a context that is no candidate has its suffix's."""
    return np.where(n >= MIN_COUNT, (count + kinds * base) / np.maximum(n + kinds, 1), base)


def short_contexts(rows: DataFrame, dense: np.ndarray) -> Short:
    def add(table: pa.Table) -> pa.Table:
        k, c = _sum_by_key([_unpack_keys(x) for x in table.column("keys").to_pylist()],
                           [_unpack_planes(x, np.int64) for x in table.column("counts").to_pylist()])
        return pa.table({"kind": table.column("kind").slice(0, 1), "keys": pa.array([_pack_keys(k)], pa.binary()),
                         "counts": pa.array([_pack_planes(c)], pa.binary())})

    # at most 2^24 byte triples, and 256 next bytes of each dense context
    got = rows.where(F.col("kind").isin(SHORT, DENSE)).select("kind", "bucket", "keys", "counts").groupBy("kind", "bucket") \
        .applyInArrow(add, "kind int, keys binary, counts binary").collect()

    def of(kind: int) -> tuple[np.ndarray, np.ndarray]:
        mine = [r for r in got if r.kind == kind]
        return _sum_by_key([np.zeros(0, U64)] + [_unpack_keys(r["keys"]) for r in mine],
                           [np.zeros(0, np.int64)] + [_unpack_planes(r["counts"], np.int64) for r in mine])
    return Short(*of(SHORT), dense, *of(DENSE))


def log_probabilities(keys: np.ndarray, counts: np.ndarray, short: Short) -> np.ndarray:
    """log10 probability of each key's byte after its longest retained context.
    ``keys``: ascending, all keys of the corpus with the same three nearest bytes (four,
    where three are dense) or several such sets; ``counts``: in training, 0 for keys
    only asked for."""
    if not len(keys):
        return np.zeros(0, np.float32)
    entry, count, up = {DEPTH: shorter_keys(keys, DEPTH)}, {DEPTH: counts}, {}
    for d in range(DEPTH, 2, -1):  # entries (context, byte) of each depth, and each one's entry a byte shorter
        entry[d - 1], up[d] = np.unique(shorter_keys(entry[d], d - 1, d), return_inverse=True)
        count[d - 1] = np.bincount(up[d], count[d]).astype(np.int64)
    p, row, keep, suffix = {2: short(entry[2])}, {}, {}, {}
    for d in range(2, DEPTH + 1):
        ctx = entry[d] >> U64(8)
        new = np.concatenate([[True], ctx[1:] != ctx[:-1]])
        row[d] = np.cumsum(new) - 1
        if d == 2:
            continue
        c, base = count[d], p[d - 1][up[d]]
        if d == KEPT:  # always retained; some have their other keys in other buckets
            c, n, kinds = short.whole(entry[d], c)
            p[d] = _smoothed(c, n, kinds, base)
            continue
        n, kinds = np.add.reduceat(c, np.flatnonzero(new)), np.add.reduceat((c > 0).astype(np.int64), np.flatnonzero(new))
        p[d] = _smoothed(c, n[row[d]], kinds[row[d]], base)
        gain = np.bincount(row[d], c * np.log2(np.where(c > 0, c / np.maximum(n[row[d]], 1) / base, 1.0)), minlength=len(n))
        keep[d] = (n >= MIN_COUNT) & (gain > GAIN_BITS * kinds)
        suffix[d] = row[d - 1][up[d][new]]
    for d in range(DEPTH, KEPT + 1, -1):
        keep[d - 1][suffix[d][keep[d]]] = True
    out = p[KEPT]
    for d in range(KEPT + 1, DEPTH + 1):
        out = np.where(keep[d][row[d]], p[d], out[up[d]])
    return np.log10(out).astype(np.float32)


def gram_answers(rows: DataFrame, short) -> DataFrame:
    """Per chunk and bucket the log10 probabilities of the requested keys, in the order asked."""
    def answer(table: pa.Table) -> pa.Table:
        asked, sums = table.column("keys").to_pylist(), Grams()
        for k, c in zip(asked, table.column("counts").to_pylist(), strict=True):
            sums.put(_unpack_keys(k), _unpack_planes(c, np.int32).astype(np.int64))
        keys, counts = sums.merge()
        value = log_probabilities(keys, counts, short.value)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "counts": pa.array(
            [_pack_planes(value[np.searchsorted(keys, _unpack_keys(k))]) for k in asked], pa.binary())})

    return rows.where(F.col("kind") == GRAMS).select("chunk", "bucket", "keys", "counts") \
        .groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, counts binary")


def document_scores(rows: DataFrame, answers: DataFrame, buckets: int, dense: np.ndarray, n: int, v: int, ends: int) -> DataFrame:
    """Add-one unigram scores and the model's scores: a chunk's documents meet the
    answers (by kind) to its words and context keys."""
    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(mine: pa.Table, found: pa.Table) -> pa.Table:
        docs = mine.filter(pc.equal(mine.column("kind"), DOC)).sort_by("bucket")
        raw = mine.filter(pc.equal(mine.column("kind"), TEXT)).sort_by("bucket").column("keys").to_pylist()
        size, tokens = docs.column("symbols").to_numpy(), docs.column("n_tokens").to_numpy()
        upto = np.concatenate([[0], np.cumsum(size + DEPTH)])
        parts, lo, uniq, keys, unpack = [], 0, Distinct(), Distinct(), zstandard.ZstdDecompressor()
        for x in raw:  # the documents of each stored piece
            text = np.frombuffer(unpack.decompress(x), np.uint8)
            hi = int(np.searchsorted(upto, upto[lo] + len(text)))
            off = upto[lo: hi + 1] - upto[lo]
            *spans, first = word_spans(text, off, SPACED)
            parts.append((x, lo, hi, word_hashes(text, *spans), np.diff(first)))
            uniq.add(parts[-1][3])
            keys.add(_contexts(text, off))
            lo = hi
        uniq, keys = uniq.merge(), keys.merge()
        got = sorted(zip(found.column("kind").to_pylist(), found.column("bucket").to_pylist(), found.column("counts").to_pylist(),
                         strict=True), key=lambda r: r[:2])
        count = np.concatenate([np.zeros(0, np.int64)] + [_unpack_planes(x, np.int64) for kind, _, x in got if kind == WORDS])
        model = np.zeros(len(keys), np.float32)
        model[gram_buckets(keys, buckets, dense)[0]] = np.concatenate(
            [np.zeros(0, np.float32)] + [_unpack_planes(x, np.float32) for kind, _, x in got if kind == GRAMS])
        value, known = np.log10((count + 1) / (n + v + 1)), count > 0
        end = math.log10((ends + 1) / (n + v + 1))
        base, n_known, total = np.zeros(len(size)), np.zeros(len(size), np.int64), np.zeros(len(size))
        for x, lo, hi, w, in_doc in parts:
            doc = np.repeat(np.arange(hi - lo), in_doc)
            at = np.searchsorted(uniq, w)
            base[lo:hi] = np.bincount(doc, value[at], minlength=hi - lo) + end
            n_known[lo:hi] = np.bincount(doc, known[at], minlength=hi - lo) + (ends > 0)
            k = _contexts(np.frombuffer(unpack.decompress(x), np.uint8), upto[lo: hi + 1] - upto[lo])
            per_byte = _looked_up(k, keys, model)
            total[lo:hi] = np.bincount(np.repeat(np.arange(hi - lo), size[lo:hi]), per_byte, minlength=hi - lo)
        return pa.table([docs.column("doc_id"), docs.column("held_out"), pa.array(tokens), pa.array(n_known),
                         pa.array(np.full(len(size), n)), pa.array(base), pa.array(total)], schema=schema)

    docs = rows.where(F.col("kind").isin(DOC, TEXT)).select("kind", "chunk", "bucket", "doc_id", "held_out", "n_tokens", "symbols", "keys")
    return docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, ddl)


def _radix_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of 64-bit keys, 16 bits at a time: numpy sorts those in linear time."""
    digits = np.ascontiguousarray(keys, "<u8").view("<u2").reshape(-1, 4)
    order = np.argsort(digits[:, 0], kind="stable")
    for i in range(1, 4):
        order = order[np.argsort(digits[:, i].copy()[order], kind="stable")]
    return order


def _looked_up(asked: np.ndarray, keys: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Value of each asked key, as doubles; all are among the ascending ``keys``. Distinct
    ones are searched for once."""
    out = np.empty(len(asked))
    if len(asked):
        order = _radix_order(asked)
        k = asked[order]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        out[order] = np.repeat(value[np.searchsorted(keys, k[new])], np.diff(np.append(new, len(k))))
    return out


def _contexts(text: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Context keys of spelled documents."""
    return context_keys(text, own_bytes(off[:-1] + DEPTH, off[1:]))


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row of ``df``; trains on the rows that are not held out."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")) \
        .select("doc_id", held_out().alias("held_out"), "text")
    dense = dense_contexts(docs)
    rows = saved(read_corpus(docs, buckets, dense), "corpus")
    answers, n, v = word_answers(rows)
    ends = rows.where((F.col("kind") == DOC) & ~F.col("held_out")).count()
    short = spark.sparkContext.broadcast(short_contexts(rows, dense))
    words, grams = (x.select("chunk", "bucket", "counts", F.lit(kind).alias("kind"))
                    for x, kind in ((answers, WORDS), (gram_answers(rows, short), GRAMS)))
    out = saved(document_scores(rows, words.unionByName(grams), buckets, dense, n, v, ends), "scores")
    short.destroy()
    return out
