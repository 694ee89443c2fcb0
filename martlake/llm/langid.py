"""Language identification by cross-parsing entropy (Ziv and Merhav).

For every language the labelled text of a bounded sample becomes a suffix
automaton. A document is parsed against each automaton into longest matches: a
phrase ends where no substring of the labelled text continues it. The entropy
estimate is ``phrases * log2(labelled symbols) / symbols``, with the symbols of the
largest sample for every language alike (a language with little text would make
its phrases cheap otherwise); the language with the smallest one, i.e. the fewest
normalised phrases, wins (ties: the smallest name).

Symbols: runs of anything but letters are one symbol, letters that the labelled
text lacks are one symbol. The most frequent ``DIRECT`` letters of the labelled text
are a symbol each; all its other letters are spelled with the same number of
digits each, so no two letters are alike, in any script. Texts are parsed
whole, in stretches of 512 symbols (a phrase also ends at a stretch's end, for
all languages alike).

Bounds of the sample: ``SAMPLE_DOCS`` labelled documents a language, of any length (of
one above ``SAMPLE_CHARS`` characters a stretch of that length, from a place that
its hash names), ``LANGUAGE_SYMBOLS`` symbols a language and ``ALL_SYMBOLS`` of all
languages together (with more than 16 languages each gets its share); at most the
``LANGUAGES`` languages with most labelled documents are learned.

The score is ``1 / sum over languages 2^(-(h - h_min) * min(symbols, 32))``.

Defined cases: null text, or a text without a letter, is ``und`` with score 0;
without any labelled row every document is ``und``; a null doc_id is neither
held out nor learned from; repeated rows are predicted each.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm.automata import columns, stretches, suffix_automaton
from martlake.llm.text import without

STRETCH = 512
SAMPLE_DOCS, SAMPLE_CHARS, LANGUAGE_SYMBOLS, ALL_SYMBOLS, LANGUAGES = 48, 20_000, 32_768, 1 << 19, 4096
UND = "und"
#: symbols: 0 no letter, 1 a letter that the labelled text lacks, DIRECT frequent letters,
#: DIGITS digits that spell the others, 47 behind the end
DIRECT, DIGITS, ALPHABET = 37, 8, 48


@functools.cache
def _letters() -> np.ndarray:
    """1 for every code point that is a letter, else 0."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), np.uint8)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


class Letters:
    """Symbols of letters, by their counts in the labelled text."""

    def __init__(self, counts: Counter):
        ranked = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
        self.lut = _letters().astype(np.int32)  # 1: a letter that isn't ranked
        rest = max(0, len(ranked) - DIRECT)
        self.width = 1
        while DIGITS ** self.width < rest:
            self.width += 1
        for i, c in enumerate(ranked):  # a spelled letter: behind the symbols, by its number
            self.lut[ord(c)] = i + 2 if i < DIRECT else ALPHABET + i - DIRECT

    def __call__(self, codes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of concatenated texts, runs of non-letters as one; new offsets."""
        sym = self.lut[codes]
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
        starts = off[:-1][off[:-1] < len(sym)]
        keep[starts] = True
        upto = np.concatenate([[0], np.cumsum(keep)])
        sym, off = sym[keep], upto[off]
        spelled = sym >= ALPHABET
        if not spelled.any():
            return sym.astype(np.uint8), off
        size = np.where(spelled, self.width, 1)
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1])) - np.repeat(ends - size, size)
        number = np.repeat(sym, size)
        digit = (number - ALPHABET) // DIGITS ** np.minimum(place, 10) % DIGITS
        out = np.where(number >= ALPHABET, 2 + DIRECT + digit, number)
        return out.astype(np.uint8), np.concatenate([[0], ends])[off]


def held_out(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text is divisible by ``folds`` (a null id: false)."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


class Model:
    """Automata of all languages in one flat table: entry = next row * 2 + phrase end."""

    def __init__(self, sample: dict[str, list[str]]):
        self.langs = sorted(sample)
        budget = min(LANGUAGE_SYMBOLS, ALL_SYMBOLS // max(1, len(self.langs)))
        self.symbols = Letters(Counter(c for ts in sample.values() for t in ts for c in t.lower() if unicodedata.category(c)[0] == "L"))
        self.root, tables, rows, largest = [], [], 0, 2
        for lang in self.langs:
            codes = np.concatenate([_codes(t + " ") for t in sample[lang]] or [np.zeros(0, "<u4")])
            sym = self.symbols(codes, np.array([0, len(codes)]))[0][:budget]
            largest = max(largest, len(sym))
            moves = suffix_automaton(sym.tolist(), ALPHABET)
            # after a symbol that the labelled text lacks, in the last state, nothing continues
            moves = np.concatenate([moves, np.full((1, ALPHABET), -1)])
            fail = moves < 0
            start = np.where(fail[0], len(moves) - 1, moves[0])
            moves = np.where(fail, start[None, :], moves) + rows
            fail[0] = False  # the first phrase is counted from the beginning
            entry = (moves * ALPHABET << 1) | fail
            entry[:, ALPHABET - 1] = (np.arange(len(moves)) + rows) * ALPHABET << 1
            tables.append(entry)
            self.root.append(rows * ALPHABET)
            rows += len(moves)
        self.log = float(np.log2(largest))
        self.table = np.concatenate(tables).astype(np.int32).ravel() if tables else np.zeros(0, np.int32)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(entropy by language and text, symbols by text)."""
        parts = [_codes(t) for t in texts]
        off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        sym, off = self.symbols(np.concatenate(parts), off)
        n, phrases = np.diff(off), np.zeros((len(self.langs), len(texts)))
        doc, begin, end = stretches(off, STRETCH)
        lanes = max(256, (1 << 21) // STRETCH)
        for a in range(0, len(doc), lanes):
            cols = columns(sym, begin[a: a + lanes], end[a: a + lanes], ALPHABET - 1).astype(np.int32)
            state = np.repeat(np.array(self.root, np.int32)[:, None], cols.shape[1], axis=1)
            count = np.ones(state.shape, np.int32)
            for step in cols:
                entry = self.table[state + step]
                count += entry & 1
                state = entry >> 1
            for i in range(len(self.langs)):
                phrases[i] += np.bincount(doc[a: a + lanes], weights=count[i], minlength=len(texts))
        return phrases * self.log / np.maximum(n, 1), n

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float], list[int], list[bool]]:
        """(language, score, smallest entropy, symbols, has a letter) of each text."""
        lang, score, best, size_of = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [0] * len(texts)
        lettered = [bool(t) and bool(_letters()[_codes(t)].any()) for t in texts]
        known = [i for i, t in enumerate(texts) if t]
        lo = 0
        while lo < len(known) and self.langs:
            hi, size = lo, 0
            while hi < len(known) and (hi == lo or size + len(texts[known[hi]]) <= 1 << 20):
                size += len(texts[known[hi]])
                hi += 1
            rows = known[lo:hi]
            lo = hi
            h, n = self.entropies([texts[i] for i in rows])
            first = h.argmin(axis=0)
            least = h.min(axis=0)
            conf = 1.0 / np.exp2(-(h - least) * np.minimum(n, 32)).sum(axis=0)
            for j, i in enumerate(rows):
                size_of[i] = int(n[j])
                if lettered[i]:
                    lang[i], score[i], best[i] = self.langs[first[j]], float(conf[j]), float(least[j])
        return lang, score, best, size_of, lettered


def labelled_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, list[str]]:
    """``SAMPLE_DOCS`` learnable documents of every language, those with the smallest
    hashes of id and text (equal rows count once): a bounded sample whatever the
    table's size and whatever its documents' lengths."""
    spot = F.xxhash64("doc_id", "text")
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                     F.col(f"`{lang_col}`").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")) \
        .select("lang", "doc_id", spot.alias("spot"), _stretch("text", spot).alias("text"))
    sizes = F.broadcast(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    # a hash threshold leaves some times the documents asked for, before they are ranked
    few = F.pmod("spot", F.lit(1 << 20)) <= F.lit(4.0 * SAMPLE_DOCS) * (1 << 20) / F.col("n")
    near = rows.join(sizes, "lang").where(few).groupBy("lang", "doc_id", "spot").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("spot", F.lit(1 << 20)), "spot", "doc_id"))
    out: dict[str, list[str]] = {}
    for r in near.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS).orderBy("lang", "doc_id", "spot").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


def _stretch(text: str, spot: Column) -> Column:
    """The text, or a stretch of ``SAMPLE_CHARS`` characters of a longer one."""
    room = F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(0))
    return F.substring(text, (F.pmod(F.shiftright(spot, 20), room + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, entropy, symbols, letters, fp) of every row of ``df``."""
    model = df.sparkSession.sparkContext.broadcast(Model(labelled_sample(df, id_col, text_col, lang_col)))

    def run(it):
        for b in it:
            lang, score, best, n, letters = model.value.predict(b.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(best, pa.float64()), pa.array(n, pa.int64()), pa.array(letters, pa.bool_()), b.column(2)],
                                             ["doc_id", "held_out", "lang_pred", "score", "entropy", "symbols", "letters", "fp"])

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                     F.xxhash64(F.col(f"`{text_col}`")).alias("fp"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, entropy double, "
                                "symbols long, letters boolean, fp long")


def keep_language(df: DataFrame, least: int = 32) -> DataFrame:
    """``df`` without the rows in no language: those without a letter, and those of
    at least ``least`` symbols that cost more bits than symbols spread evenly
    over the alphabet, whatever the language (none, if no language was learned).
    All columns stay."""
    no = ~F.col("letters") | ((F.col("symbols") >= least) & (F.col("entropy") > float(np.log2(ALPHABET))))
    return without(df, identify(df).where(no))
