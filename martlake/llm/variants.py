"""Spelling variants by blocked Gram matrices.

1. ``word_counts`` cuts every text into runs of letters, applies the fixed rule that
   drops one letter of some occurrences, and counts the words that result.
2. Words of one length are a block. A near word has the same length or one letter
   more, so a block meets itself and the next longer one. A block is split by
   where the one edit may be (``_split``): words whose edit falls into a stretch of
   positions agree in all the rest, so the rest is the key of a smaller block.
   Splitting stops as soon as a block has at most ``BLOCK`` words, or when the
   stretch is one position (then the alphabet bounds the block). Every pair has
   exactly one stretch at each step, so no pair is lost or met twice.
3. In a block, words are vectors of letter counts. One product of the vectors gives
   all squared distances; one edit changes them by at most 2. Pairs beyond go;
   the rest is verified letter by letter.
4. A word's form is the near word of largest count; forms are followed to the end
   by pointer doubling (counts grow tenfold at every step, so chains are short).

Block sizes come from an aggregate; hot blocks are split before any of their rows
meet in a task. A word has at most some 90 * (2 * length + 1) near words, so no
join here has a hot key.

Defined cases: null text = no words; a null doc_id counts as the empty string in the
rule's key; repeated rows count each; no word gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import LOWER, blocks, saved, texts, word_hashes, word_spans

LEAST = 7  # letters of a word
FEWEST = 2  # occurrences of a word
DROPPED = 31  # one of so many occurrences loses a letter
RATIO = 10  # a form is so many times as frequent
BLOCK = 512  # words of a block that isn't split further
CELLS = 1 << 22  # letters compared at once

_ASCII = np.zeros(256, bool)
_ASCII[0x41:0x5B] = _ASCII[0x61:0x7B] = True
#: letter by code point: a-z, then U+00C0..U+00FF; 0: none
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x61:0x7B] = np.arange(1, 27)
_LETTER[0xC0:0x100] = np.arange(27, 91)
LETTERS = 91


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()
SHORT = 64  # bytes of a run whose checksum is combined by table


def _shifted(crc: np.ndarray) -> np.ndarray:
    """``out[n]``: what a checksum contributes n bytes later (checksums are linear:
    crc(a + b) = shifted(crc(a), len(b)) ^ crc(b))."""
    out = np.empty((SHORT + 1, len(crc)), np.uint32)
    out[0] = crc
    for n in range(SHORT):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ _CRC[out[n] & np.uint32(255)]
    return out


def _letter_runs(data: np.ndarray, off: np.ndarray):
    """Spans of ``[A-Za-z\\u00C0-\\u00FF]+`` in UTF-8 (U+00C0..U+00FF are C3 80..C3 BF)."""
    lead = data == 0xC3
    letter = _ASCII[data] | lead
    letter[1:] |= lead[:-1]
    # spans are looked up by byte value: mark the letters
    return word_spans(letter.view(np.uint8), off, _MARKED)


_MARKED = np.zeros(256, bool)
_MARKED[1] = True


def block_counts(ids: list, data: np.ndarray, off: np.ndarray) -> dict[str, int]:
    """Occurrences of the words of some documents, after the rule."""
    data = LOWER[data]
    starts, ends, first = _letter_runs(data, off)
    leads = np.concatenate([[0], np.cumsum(data == 0xC3)])
    size = ends - starts - (leads[ends] - leads[starts])
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    keep = size >= LEAST  # a letter less can't make a word of a shorter run
    starts, ends, size, doc = starts[keep], ends[keep], size[keep], doc[keep]
    if not len(starts):
        return {}
    raw = data.tobytes()
    _, where, back, n = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    words = [raw[a:z] for a, z in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    lead = [b"" if i is None else b"%d" % i for i in ids]
    ahead = _shifted(np.array([zlib.crc32(x + b":") for x in lead], np.uint32))
    length = ends - starts
    h = ahead[np.minimum(length, SHORT), doc] ^ own[back]
    for i in np.flatnonzero(length > SHORT).tolist():
        h[i] = zlib.crc32(lead[doc[i]] + b":" + words[back[i]])
    changed = np.flatnonzero(h % np.uint32(DROPPED) == 0)
    n = n - np.bincount(back[changed], minlength=len(n))
    out = {w.decode(): int(k) for w, k in zip(words, n.tolist(), strict=True) if k}
    for u, at in zip(back[changed].tolist(), (h[changed].astype(np.int64) % size[changed]).tolist(), strict=True):
        w = words[u].decode()
        if len(w) > LEAST:
            w = w[:at] + w[at + 1:]
            out[w] = out.get(w, 0) + 1
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of at least ``LEAST`` letters, over all texts."""
    def run(it):
        for b in it:
            ids = b.column(0).to_pylist()
            for lo, hi, data, off in blocks(b.column(1)):
                found = block_counts(ids[lo:hi], data, off)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                                 ["word", "n"])
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- blocks --------------------------------------------------------------------

def _key(lo: Column, hi: Column) -> Column:
    """Hash of what a word has outside of the stretch lo..hi of the shorter word's
    positions (a word one letter longer has one more inside)."""
    after = hi + F.length("word") - F.col("short")
    return F.xxhash64(F.substring("word", F.lit(1), lo), F.substring("word", after + 1, F.length("word")))


def _split(rows: DataFrame) -> DataFrame:
    """Both halves of each row's stretch."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi"))))
    return rows.select("word", "n", "short", halves.alias("h")) \
        .select("word", "n", "short", F.col("h.lo").alias("lo"), F.col("h.hi").alias("hi")) \
        .withColumn("key", _key(F.col("lo"), F.col("hi")))


BLOCK_KEY = ["short", "lo", "hi", "key"]


def word_blocks(words: DataFrame, block: int) -> DataFrame:
    """(word, n, short, lo, hi, key): each word in its blocks, as one of the shorter
    words (length = short) and of the longer ones (length = short + 1)."""
    both = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("short")) \
        .where(F.col("short") >= LEAST)
    open_ = saved(_split(both.withColumn("lo", F.lit(0)).withColumn("hi", F.col("short"))), "variant-blocks")
    done = []
    while True:
        hot = open_.where(F.col("hi") - F.col("lo") > 1).groupBy(*BLOCK_KEY).agg(F.count(F.lit(1)).alias("size")) \
            .where(F.col("size") > block).drop("size")
        hot = saved(hot, "variant-hot")
        if not hot.take(1):
            done.append(open_)
            break
        done.append(open_.join(hot, BLOCK_KEY, "left_anti").select(open_.columns))
        open_ = saved(_split(open_.join(hot, BLOCK_KEY, "left_semi")), "variant-blocks")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _codes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of words one after the other, and their offsets."""
    col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]: off[-1]]
    lead = data == 0xC3
    after = np.concatenate([[False], lead[:-1]])
    upto = np.concatenate([[0], np.cumsum(~lead)])
    return _LETTER[(data + (after * np.uint8(0x40)).astype(np.uint8))[~lead]], upto[off - off[0]]


def near_in_blocks(letters: np.ndarray, off: np.ndarray, short: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                   group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of one group (ascending) that differ by one edit inside
    of their stretch; i has the length ``short``."""
    size = np.diff(off)
    rows, width = len(size), int(size.max())
    grid = np.zeros((rows, width + 1), np.uint8)
    row = np.repeat(np.arange(rows), size)
    grid[row, np.arange(len(letters)) - np.repeat(off[:-1], size)] = letters
    kind = np.float32 if width < 2048 else np.float64  # sums of squares stay exact
    count = np.bincount(row * LETTERS + letters, minlength=rows * LETTERS).reshape(rows, LETTERS).astype(kind)
    square = np.einsum("ij,ij->i", count, count)
    a = np.flatnonzero(size == short)
    longer = size > short
    found = []
    for at in range(0, len(a), BLOCK):
        i = a[at: at + BLOCK]
        gram = count[i] @ count.T
        near = square[i][:, None] + square[None, :] - 2 * gram <= 2
        near &= group[i][:, None] == group[None, :]
        x, y = np.nonzero(near)
        x = i[x]
        keep = (y > x) | longer[y]
        found.append((x[keep], y[keep]))
    x, y = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*found, strict=True)) if found else (a, a)
    ok = np.zeros(len(x), bool)
    step = max(1, CELLS // (width + 1))
    for at in range(0, len(x), step):
        i, j = x[at: at + step], y[at: at + step]
        same = grid[i] == grid[j]
        p = np.where(same.all(axis=1), width + 1, same.argmin(axis=1))  # first difference
        later = grid[i][:, :-1] == grid[j][:, 1:]
        place = np.arange(width)[None, :]
        one = ((~same).sum(axis=1) == 1) & ~longer[j]
        inserted = (later | (place < p[:, None])).all(axis=1) & longer[j]
        s = short[i]
        inside = (p >= lo[i]) & ((p < hi[i]) | (longer[j] & (p == s) & (hi[i] == s)))
        ok[at: at + step] = (one | inserted) & inside
    return x[ok], y[ok]


def near_pairs(rows: DataFrame) -> DataFrame:
    """(word, near, near_n) for both directions of every near pair."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def pairs(t: pa.Table):
        """Pairs of whole groups, some hundred rows at a time."""
        key = np.column_stack([t.column(c).to_numpy().astype(np.int64) for c in BLOCK_KEY])
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(new, len(key)))
        group = np.repeat(np.arange(len(new)), sizes)
        keep = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(keep):
            return
        t, key, group = t.take(pa.array(keep)), key[keep], group[keep]
        word, n = t.column("word").combine_chunks(), t.column("n").to_numpy()
        letters, off = _codes(word)
        bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist() + [len(group)]
        lo = 0
        while lo < len(bounds) - 1:
            hi = lo + 1
            while hi < len(bounds) - 1 and bounds[hi + 1] - bounds[lo] <= BLOCK and off[bounds[hi + 1]] - off[bounds[lo]] <= CELLS:
                hi += 1
            a, z = bounds[lo], bounds[hi]
            lo = hi
            i, j = near_in_blocks(letters[off[a]: off[z]], off[a: z + 1] - off[a], *key[a:z, :3].T, group[a:z])
            if len(i):
                x, y = np.concatenate([i, j]) + a, np.concatenate([j, i]) + a
                yield pa.RecordBatch.from_arrays([word.take(pa.array(x)), word.take(pa.array(y)), pa.array(n[y])], schema=schema)

    def run(it):
        rest = None
        for b in it:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            key = [t.column(c).to_numpy() for c in BLOCK_KEY]
            other = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0)) if len(t) else []
            cut = int(other[-1]) + 1 if len(other) else 0  # the last group may go on in the next batch
            if cut:
                yield from pairs(t.slice(0, cut))
            rest = t.slice(cut)
        if rest is not None and len(rest):
            yield from pairs(rest)

    return rows.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).select("word", "n", *BLOCK_KEY) \
        .mapInArrow(run, "word string, near string, near_n long")


def ends_of_chains(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the end by pointer doubling."""
    roots = saved(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "variant-roots")
        roots = step.drop("moved")
        if not step.where("moved").take(1):
            return roots


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``df``'s texts."""
    words = saved(word_counts(texts(df, id_col, text_col)).where(F.col("n") >= FEWEST), "variant-words")
    near = near_pairs(word_blocks(words, block)).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = F.col("best").isNotNull() & (-F.col("best.less") >= F.lit(RATIO) * F.col("n"))
    out = saved(words.join(near, "word", "left").select(
        "word", F.when(named, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(named, -F.col("best.less")).alias("form_n")), "variant-forms")
    roots = ends_of_chains(out.where(F.col("form").isNotNull()))
    return out.join(roots, "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
