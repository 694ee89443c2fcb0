"""Best-fit-decreasing packing of token pieces into fixed-length sequences.

Lengths are integers up to the capacity, so all pieces of one length are alike
and the whole run is decided on a histogram of at most ``capacity`` counts, at
any input size: ``plan`` takes lengths from long to short, and a segment tree
over remaining capacities finds the tightest open sequences in logarithmic
time. The outcome is the one of best-fit decreasing piece by piece. Its table
of runs (length, ranks, sequences, offset) is applied to all pieces, which are
numbered within their length in parallel.

Tokens: a text's ids are those of its units one after the other (the tokenizer
drops white space and never joins across it, see ``units``). Each distinct unit
is encoded once and remembered; ids are then gathered by numpy. A text that holds
the text of one of the tokenizer's added tokens (such as its end mark) is encoded
whole by the tokenizer, which gives that token's id there.

Defined cases: null text = empty, which is the one id 0; repeated rows are
packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.text import LOWER, SPACED, blocks, saved, texts, word_hashes, word_spans

CAPACITY = 2048
LANE = 50_000  # pieces of a lane
#: byte classes for cutting: 1 ASCII letters and digits, 2 ASCII punctuation without the apostrophe
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 2
_CLASS[0x27] = 0
_CLASS[0x30:0x3A] = _CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1


def units(data: np.ndarray, off: np.ndarray):
    """White-space separated chunks, also cut between an ASCII letter or digit and
    ASCII punctuation. The tokenizer's own word rule always cuts there (only
    its contractions join an apostrophe and letters, so that one is left out)."""
    c = _CLASS[data]
    return word_spans(data, off, SPACED, (c[1:] + c[:-1] == 3) & (c[1:] > 0) & (c[:-1] > 0))


class ChunkEncoder:
    """Ids of units, remembered by hash of their bytes."""

    LIMIT = 400_000  # remembered units; then the memory starts anew

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.plain = Tokenizer.from_file(path)
        # texts that hold one of the tokenizer's added tokens go through it whole
        self.added = [t.content.lower().encode() for t in self.plain.get_added_tokens_decoder().values()]
        vocab = self.plain.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.slot: dict[int, int] = {}
        # slot 0: the end of a document
        self.begin, self.count, self.pool = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.uint32)

    def remember(self, hashes: list[int], ids: np.ndarray, count: np.ndarray) -> None:
        """Units by hash: their ids one after the other, and each one's number of ids."""
        first = len(self.begin)
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.pool = np.concatenate([self.pool, ids])
        self.slot.update(zip(hashes, range(first, first + len(hashes)), strict=True))

    def learn(self, words: list[str], hashes: list[int]) -> None:
        # units of letters only are one word of the tokenizer each: encoded together, parted at word ends
        is_even = [w.isalpha() and (w.isascii() or is_normalized("NFC", w)) for w in words]
        even = [w for w, e in zip(words, is_even, strict=True) if e]
        if even:
            flat = np.array(self.plain.encode_batch_fast([" ".join(even)], add_special_tokens=False)[0].ids, np.uint32)
            stop = np.flatnonzero(self.ends_word[flat]) + 1
            if len(stop) == len(even):
                self.remember([h for h, e in zip(hashes, is_even, strict=True) if e], flat[:stop[-1]], np.diff(stop, prepend=0))
            else:
                is_even = [False] * len(words)
        odd = [w for w, e in zip(words, is_even, strict=True) if not e]
        if odd:
            ids = [e.ids for e in self.plain.encode_batch_fast(odd, add_special_tokens=False)]
            self.remember([h for h, e in zip(hashes, is_even, strict=True) if not e], np.array(list(chain.from_iterable(ids)), np.uint32),
                          np.array([len(x) for x in ids], np.int64))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, each ended by id 0; offsets by document)."""
        if len(self.slot) > self.LIMIT:
            self.reset()
        lower = LOWER[data]
        special = self.with_added(lower, off)
        if len(special):
            return self.patched(data, off, special)
        data = lower
        starts, ends, first = units(data, off)
        uniq, where, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        hashes = uniq.tolist()
        new = [i for i, h in enumerate(hashes) if h not in self.slot]
        if new:
            raw = data.tobytes()
            self.learn([raw[starts[j]: ends[j]].decode("utf-8", "replace") for j in where[new].tolist()],
                       [hashes[i] for i in new])
        slots = np.array([self.slot[h] for h in hashes], np.int64)[back] if hashes else np.zeros(0, np.int64)
        slots = np.insert(slots, first[1:], 0)
        begin, count, pool = self.begin, self.count, self.pool
        n = count[slots]
        at = np.cumsum(n) - n
        ids = pool[np.arange(int(n.sum())) + np.repeat(begin[slots] - at, n)]
        upto = np.concatenate([[0], np.cumsum(n)])
        return ids, upto[np.concatenate([[0], first[1:] + np.arange(1, len(first))])]


    def with_added(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Documents in whose (lower-cased) text an added token's text stands."""
        raw, at = data.tobytes(), []
        for token in self.added:
            i = raw.find(token)
            while i >= 0:
                d = int(np.searchsorted(off, i, "right")) - 1
                at.append(d)
                i = raw.find(token, max(i + 1, int(off[d + 1]) - len(token) + 1))  # once a document
        return np.unique(np.array(at, np.int64))

    def patched(self, data: np.ndarray, off: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids with those of the documents ``special`` from the tokenizer's own call."""
        sizes = np.diff(off)
        plain = np.ones(len(sizes), bool)
        plain[special] = False
        ids, upto = self.encode(data[np.repeat(plain, sizes)], np.concatenate([[0], np.cumsum(np.where(plain, sizes, 0))]))
        out, length = [], np.diff(upto)
        for d in range(len(sizes)):
            part = ids[upto[d]: upto[d + 1]]
            if not plain[d]:
                text = data[off[d]: off[d + 1]].tobytes().decode("utf-8", "replace")
                part = np.array([*self.plain.encode(text, add_special_tokens=False).ids, 0], np.uint32)
                length[d] = len(part)
            out.append(part)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(length)])


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as token pieces; only
    those longer than ``capacity`` are cut."""
    def run(it):
        encoder = ChunkEncoder(tokenizer_path)
        for b in it:
            ids = b.column(0).to_pylist()
            for lo, _, data, off in blocks(b.column(1), 2 << 20):
                tokens, upto = encoder.encode(data, off)
                raw = memoryview(tokens.astype("<u4")).cast("B")
                out = []
                for d in range(len(upto) - 1):
                    a, z = int(upto[d]), int(upto[d + 1])
                    for i, s in enumerate(range(a, z, capacity)):
                        e = min(z, s + capacity)
                        out.append((ids[lo + d], i, s - a, e - s, zlib.crc32(raw[4 * s: 4 * e])))
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Tightest:
    """Segment tree over remaining capacities 0..n: is any sequence open there?"""

    def __init__(self, n: int):
        self.width = 1 << n.bit_length()
        self.any = [False] * (2 * self.width)

    def put(self, at: int, open_: bool) -> None:
        i = at + self.width
        self.any[i] = open_
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def at_least(self, low: int) -> int | None:
        """Smallest open capacity not below ``low``."""
        i = low + self.width
        while not self.any[i]:
            while i & 1:  # right child: go up until there is a right sibling
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.width:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.width


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, first rank, number, first sequence, offset): the pieces of
    that length with those ranks go to that many consecutive sequences."""
    tree, open_, used, runs = Tightest(capacity), {}, 0, []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:  # a new sequence takes as many of them as fit before the next is opened
                room, first, number = capacity, used, max(1, -(-left // (capacity // length)))
                used += number
            else:
                first, number = open_[room].pop()
                if not open_[room]:
                    tree.put(room, False)
            each = min(room // length, left)
            take = min(number, left // each)
            for j in range(each):
                runs.append((length, rank + j * take, take, first, capacity - room + j * length))
            rank, left = rank + each * take, left - each * take
            rest = [(room - each * length, first, take)]
            if number > take:
                rest.append((room, first + take, number - take))
            for cap, seq, n in rest:
                if cap == capacity and n:
                    used -= n  # not needed yet: opened again below
                elif n:
                    open_.setdefault(cap, []).append((seq, n))
                    tree.put(cap, True)
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, lanes: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Pieces of one length are numbered in ``lanes`` parts (default: one for each
    ``LANE`` pieces of the whole, so that a length that most pieces have is as many
    groups as it needs); the lanes' counts give each lane's first number.
    """
    spark = df.sparkSession
    rows = saved(pieces(texts(df, id_col, text_col), tokenizer_path, capacity), "pieces")
    lanes = lanes or -(-rows.count() // LANE) + 1  # counted from Parquet footers
    place = F.xxhash64(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), "_metadata.row_index")
    rows = rows.withColumn("lane", F.pmod(place, F.lit(lanes)).cast("int"))  # by place, so that repeated rows are spread too
    counts = rows.groupBy("length", "lane").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(histogram, capacity)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    shared = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    inside = Window.partitionBy("length", "lane").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("nth", F.row_number().over(inside) - 1).join(first, ["length", "lane"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_rank") + F.col("nth")).alias("rank"))

    def place(it):
        table = shared.value
        key = table[:, 0] * (1 << 44) + table[:, 1]
        for b in it:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            i = np.searchsorted(key, length * (1 << 44) + rank, "right") - 1
            seq = table[i, 3] + rank - table[i, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq, pa.int64()), pa.array(table[i, 4], pa.int64())],
                                             [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
