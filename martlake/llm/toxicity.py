"""Severity grades by cumulative-link (proportional-odds) ordinal regression.

Sparse text features: counts of indicator words, i.e. words or word starts whose document
frequency differs significantly between toxic and clean documents of a bounded
labelled sample. The labels only say toxic or not; a toxic sample document's
grade 1..3 is the third of the toxic documents it falls in by its number of
indicator words, a clean one's grade is 0.

All grades share one weight vector: P(grade >= k) = sigmoid(w.x - threshold_k)
with thresholds in order. Results are the expected severity, the sum of
P(grade >= k) over k = 1..3, and the chance of any toxicity. Thresholds are
corrected from the sample's class rates to those of all labels.

Defined cases: null or wordless texts have no features (severity of the
thresholds alone); without toxic or without clean labels every document has
severity 0; repeated rows are scored each; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.labelled import one_text_each, sample_ids, sigmoid
from martlake.llm.text import ALNUM, GOLDEN, LOWER, U64, blocks, texts, word_hashes, word_spans

#: bound of the labelled sample, documents of each class
SAMPLE = {0: 6000, 1: 3000}
SIGNIFICANT = 25.0  # signed chi-square
GRADES = 3
STEM = 6  # bytes


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word, and of the first ``STEM`` bytes of longer words."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, off, ALNUM)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    long = ends - starts > STEM
    stem = word_hashes(data, starts[long], starts[long] + STEM) ^ GOLDEN
    return np.concatenate([doc, doc[long]]), np.concatenate([word_hashes(data, starts, ends), stem])


def word_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of a block's distinct words and stems."""
    doc, h = tokens(data, off)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.append(new, len(h)))


class Ordinal:
    """Indicator words (sorted hashes), shared weights and ordered thresholds."""

    def __init__(self):
        self.words, self.w, self.thresholds = np.zeros(0, U64), np.zeros(0), None

    def fit(self, doc: np.ndarray, word: np.ndarray, count: np.ndarray, toxic: np.ndarray, rate: float) -> Ordinal:
        """``doc`` indexes ``toxic``; ``rate``: toxic share of all labels."""
        n1, n0 = int(toxic.sum()), int((~toxic).sum())
        if not n1 or not n0:
            return self
        uniq, back = np.unique(word, return_inverse=True)
        a = np.bincount(back[toxic[doc]], minlength=len(uniq)).astype(np.float64)
        b = np.bincount(back[~toxic[doc]], minlength=len(uniq)).astype(np.float64)
        c, d, n = n1 - a, n0 - b, n1 + n0
        cross = np.abs(a * d - b * c) - n / 2  # continuity-corrected
        chi = np.where(cross > 0, n * cross ** 2 / np.maximum((a + b) * (c + d) * n1 * n0, 1e-9), 0.0)
        pick = np.flatnonzero((chi >= SIGNIFICANT) & (a / n1 > b / n0))
        self.words = uniq[pick]
        keep = np.isin(back, pick)
        row, col, val = doc[keep], np.searchsorted(pick, back[keep]), np.log1p(count[keep])
        hits = np.bincount(doc[keep], weights=count[keep], minlength=len(toxic))
        marked = hits[toxic & (hits > 0)]
        cuts = np.quantile(marked, [1 / 3, 2 / 3]) if len(marked) else np.array([1.0, 2.0])
        grade = np.where(toxic, 1 + np.searchsorted(cuts, hits, "left"), 0)
        self._descend(row, col, val, grade)
        self.thresholds -= np.log(rate / (1 - rate)) - np.log(n1 / n0)
        return self

    def _descend(self, row, col, val, grade, rounds: int = 1500, ridge: float = 1e-5, pace: float = 0.1) -> None:
        """Adam steps on the mean negative log likelihood; thresholds stay in order
        as first value plus positive gaps."""
        docs, k = len(grade), GRADES
        size = len(self.words) + k
        theta = np.zeros(size)
        theta[-k:] = [2.0] + [0.0] * (k - 1)
        m, v = np.zeros(size), np.zeros(size)
        for t in range(1, rounds + 1):
            w, gaps = theta[:-k], np.exp(theta[-k + 1:])
            cut = theta[-k] + np.concatenate([[0.0], np.cumsum(gaps)])
            s = np.bincount(row, weights=val * w[col], minlength=docs)
            above = np.column_stack([np.ones(docs), sigmoid(s[:, None] - cut[None, :]), np.zeros(docs)])
            slope = above * (1 - above)
            at = np.arange(docs)
            p = np.maximum(above[at, grade] - above[at, grade + 1], 1e-9)
            ds = -(slope[at, grade] - slope[at, grade + 1]) / p / docs
            dcut = np.zeros(k)
            for j in range(1, k + 1):  # raising threshold j lowers P(grade >= j)
                dcut[j - 1] = (slope[grade == j, j] / p[grade == j]).sum() / docs - (slope[grade == j - 1, j] / p[grade == j - 1]).sum() / docs
            grad = np.concatenate([np.bincount(col, weights=val * ds[row], minlength=len(w)) + ridge * w,
                                   [dcut.sum()], [dcut[j:].sum() * gaps[j - 1] for j in range(1, k)]])
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad ** 2
            theta -= pace * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        self.w = theta[:-k]
        self.thresholds = theta[-k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[-k + 1:]))])

    def score(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(expected severity, chance of any toxicity) of a block's documents."""
        docs = len(off) - 1
        if self.thresholds is None:
            return np.zeros(docs), np.zeros(docs)
        s = np.zeros(docs)
        if len(self.words):
            doc, word, count = self._indicators(data, off)
            s = np.bincount(doc, weights=np.log1p(count) * self.w[word], minlength=docs)
        above = sigmoid(s[:, None] - self.thresholds[None, :])
        return above.sum(axis=1), above[:, 0]

    def _indicators(self, data: np.ndarray, off: np.ndarray):
        """(document, indicator, count) of a block; other words are dropped first."""
        doc, h = tokens(data, off)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        hit = np.flatnonzero(self.words[at] == h)
        key, count = np.unique(doc[hit] * len(self.words) + at[hit], return_counts=True)
        return key // len(self.words), key % len(self.words), count


def fit(df: DataFrame, labels: DataFrame, label: str = "toxic", sample: dict[int, int] | None = None) -> Ordinal:
    ids, sizes = sample_ids(labels, label, sample or SAMPLE)

    def run(it):
        for b in it:
            y = b.column(0).to_pylist()
            for lo, hi, data, off in blocks(b.column(1)):
                doc, h, n = word_counts(data, off)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(y[lo:hi], pa.int32()),
                    pa.array([h[x:z].tobytes() for x, z in zip(cut, cut[1:], strict=False)], pa.binary()),
                    pa.array([n[x:z].astype(np.int32).tobytes() for x, z in zip(cut, cut[1:], strict=False)], pa.binary())],
                    ["y", "words", "counts"])

    rows = one_text_each(texts(df), ids).select("y", "text") \
        .mapInArrow(run, "y int, words binary, counts binary").dropDuplicates(["y", "words", "counts"]).collect()
    words = [np.frombuffer(r.words, U64) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(w) for w in words])
    total = sizes.get(1, 0) + sizes.get(0, 0)
    rate = min(max(sizes.get(1, 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
    none = np.zeros(0)
    return Ordinal().fit(doc, np.concatenate(words or [none.astype(U64)]),
                         np.concatenate([np.frombuffer(r.counts, np.int32) for r in rows] or [none]),
                         np.array([r.y == 1 for r in rows], bool), rate)


def severity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
             least: float = 0.25) -> DataFrame:
    """(doc_id, severity, p_toxic, toxic) of every row of ``df``."""
    docs = texts(df, id_col, text_col)
    model = df.sparkSession.sparkContext.broadcast(fit(docs, labels, label))

    def run(it):
        for b in it:
            parts = [model.value.score(data, off) for _, _, data, off in blocks(b.column(1))]
            sev, p = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sev), pa.array(p), pa.array(p >= least)],
                                             ["doc_id", "severity", "p_toxic", "toxic"])
    return docs.mapInArrow(run, "doc_id long, severity double, p_toxic double, toxic boolean")
