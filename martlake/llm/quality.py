"""Quality classifier with hierarchical empirical-Bayes site priors.

Document evidence: a ridge logistic regression over about fifty style features
of the whole text, fitted on a bounded labelled sample; its log Bayes factor is
the log odds against the sample's own rate.

Site evidence: posteriors are summed by host and by (host, path) over all
documents (grouped aggregates, partial sums first). Moments over the hosts give
the global rate and the strength of its Beta prior, moments over the paths around
their hosts the strength of the hosts'; a host's rate is shrunk towards the global
rate, a path's towards its host's, each by its size, so a sparse site stays near
what is known above it. A document's prior is its path's
rate without the document itself. Posterior odds = prior odds x Bayes factor.

Defined cases: null or empty text has zero features; null host and path are
values of their own; without labels of both kinds every document's evidence is
0 and its quality the prior 0.5; repeated rows are judged each; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.labelled import logistic, one_text_each, sample_ids
from martlake.llm.text import (LOWER, SPACED, U64, blocks, gram_hashes, keyed, saved, without, word_hashes, word_spans)

#: bound of the labelled sample, rows of each class
SAMPLE = {0: 4000, 1: 8000}
KEEP = 0.5
_PUNCT = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_FOLD = np.zeros(256, np.int64)  # byte -> counted group
for _i, _c in enumerate(_PUNCT):
    _FOLD[_c] = _i
_N = len(_PUNCT)
_FOLD[0x30:0x3A], _FOLD[0x41:0x5B], _FOLD[0x61:0x7B], _FOLD[0x80:] = _N, _N + 1, _N + 2, _N + 3
_FOLD[:0x21], _FOLD[0x0A], _FOLD[0x7F] = _N + 4, _N + 5, _N + 4
GROUPS = _N + 6
FEATURES = GROUPS + 8


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers per document of a block."""
    docs = len(off) - 1
    size = np.maximum(np.diff(off), 1)
    doc = np.repeat(np.arange(docs), np.diff(off))
    counts = np.bincount(doc * GROUPS + _FOLD[data], minlength=docs * GROUPS).reshape(docs, GROUPS)
    starts, ends, first = word_spans(data, off, SPACED)
    h = word_hashes(LOWER[data], starts, ends)
    words = np.diff(first)
    n = np.maximum(words, 1)
    word_doc = np.repeat(np.arange(docs), words)

    def share(flag: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flag, minlength=docs) / n

    def distinct(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        k = (of.astype(U64) << U64(40)) | (keys >> U64(24))
        return np.bincount((np.unique(k) >> U64(40)).astype(np.int64), minlength=docs)

    twice = np.zeros(len(h))
    twice[1:] = (h[1:] == h[:-1]) & (word_doc[1:] == word_doc[:-1])
    triples = gram_hashes(h, 3)
    inside = word_doc[: len(triples)] == word_doc[2: len(triples) + 2]
    of = word_doc[: len(triples)][inside]
    n3 = np.maximum(np.bincount(of, minlength=docs), 1)
    lens = ends - starts
    extra = [np.log1p(words), np.bincount(word_doc, weights=lens, minlength=docs) / n, share(lens > 20, word_doc),
             share(lens == 1, word_doc), share(twice, word_doc), distinct(h, word_doc) / n,
             np.where(words >= 3, distinct(triples[inside], of) / n3, 1.0), np.log1p(counts[:, GROUPS - 1])]
    return np.column_stack([np.log1p(1000.0 * counts / size[:, None]), *extra])


class Evidence:
    """Standardised logistic regression; ``log_odds`` is the log Bayes factor."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rate, self.mean, self.scale = 0.5, np.zeros(FEATURES), np.ones(FEATURES)
        self.w, self.bias = np.zeros(FEATURES), 0.0
        if len(set(y.tolist())) == 2:
            self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
            self.rate = float(y.mean())
            self.w, self.bias = logistic((x - self.mean) / self.scale, y, np.ones(len(y)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.bias
        return np.clip(z - np.log(self.rate / (1 - self.rate)), -20, 20)


def fit(df: DataFrame, labels: DataFrame, label: str, sample: dict[int, int]) -> tuple[Evidence, float]:
    """(document evidence, rate of good documents among the labels)."""
    ids, sizes = sample_ids(labels, label, sample)

    def run(it):
        for b in it:
            x = [features(data, off) for _, _, data, off in blocks(b.column(1))]
            flat = np.concatenate(x) if x else np.zeros((0, FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(flat), pa.list_(pa.float64()))], ["y", "x"])

    rows = one_text_each(keyed(df), ids).select("y", "text").mapInArrow(run, "y int, x array<double>").collect()
    x = np.array([r.x for r in rows]).reshape(-1, FEATURES)
    total = sum(sizes.values())
    rate = (sizes.get(1, 0) + 1) / (total + 2)
    return Evidence(x, np.array([r.y for r in rows], np.float64)), rate


def evidence(df: DataFrame, model: Evidence, host_col: str, path_col: str) -> DataFrame:
    """(doc_id, fp, host, path, log_odds) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(it):
        for b in it:
            z = [shared.value.log_odds(features(data, off)) for _, _, data, off in blocks(b.column(4))]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.concatenate(z) if z else np.zeros(0))],
                                             ["doc_id", "fp", "host", "path", "log_odds"])

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"),
                     F.col(f"`{host_col}`").cast("string").alias("host"), F.col(f"`{path_col}`").cast("string").alias("path"), "text")
    return rows.mapInArrow(run, "doc_id long, fp long, host string, path string, log_odds double")


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(df: DataFrame, labels: DataFrame, label: str = "quality", host_col: str = "source", path_col: str = "lang",
             sample: dict[int, int] | None = None, keep: float = KEEP) -> DataFrame:
    """(doc_id, host, path, log_odds, host_rate, site_rate, quality, keep, fp) of
    every row: ``quality`` is the posterior probability of a good document."""
    model, rate = fit(df, labels, label, sample or SAMPLE)
    rows = saved(evidence(df, model, host_col, path_col), "evidence")
    good = 1 / (1 + F.exp(-(F.col("log_odds") + float(np.log(rate / (1 - rate))))))
    paths = saved(rows.groupBy("host", "path").agg(F.sum(good).alias("s"), F.count(F.lit(1)).cast("double").alias("n")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("host_s"), F.sum("n").alias("host_n"))
    m = hosts.agg(F.sum("host_s").alias("s"), F.sum("host_n").alias("n"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("host_s") * F.col("host_s") / F.col("host_n")).alias("q"), F.sum(F.col("host_n") ** 2).alias("n2")).first()
    mean, strength = prior_moments(m.s, m.n, m.k, m.q, m.n2)
    own = path_strength(paths)
    shrunk = hosts.select(F.col("host").alias("host2"), ((F.col("host_s") + mean * strength) / (F.col("host_n") + strength)).alias("host_rate"))
    sites = paths.join(shrunk, F.col("host").eqNullSafe(F.col("host2"))) \
        .select(F.col("host").alias("host2"), F.col("path").alias("path2"), "s", "n", "host_rate")
    same = F.col("host").eqNullSafe(F.col("host2")) & F.col("path").eqNullSafe(F.col("path2"))
    prior = (F.col("s") - good + F.col("host_rate") * own) / (F.col("n") - 1 + own)
    prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    return rows.join(sites, same).withColumn("site_rate", prior) \
        .withColumn("quality", 1 / (1 + F.exp(-(F.col("log_odds") + _logit(F.col("site_rate")))))) \
        .select("doc_id", "host", "path", "log_odds", "host_rate", "site_rate", "quality",
                (F.col("quality") >= keep).alias("keep"), "fp")


def prior_moments(s: float | None, n: float | None, k: int, q: float | None, n2: float | None) -> tuple[float, float]:
    """Mean and strength (documents' worth) of the Beta prior over ``k`` groups
    from sums of good documents, sizes, squared sums over sizes and squared
    sizes: the between-group variance left after sampling noise."""
    if not n:
        return 0.5, 1.0
    mean = min(max(s / n, 1e-6), 1 - 1e-6)
    noise = mean * (1 - mean)
    if k < 2 or n - n2 / n <= 0:
        return mean, 100.0
    between = (q - n * mean * mean - (k - 1) * noise) / (n - n2 / n)
    return mean, float(min(max(noise / between - 1, 1.0), 1e6)) if between > 0 else 1e6


def path_strength(paths: DataFrame) -> float:
    """Strength of the prior over the paths of a host, of all hosts alike: the variance of
    path rates around their host's rate that sampling noise leaves. ``paths``:
    (host, path, s, n); one row reaches the driver."""
    each = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                                     F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.sum(F.col("n") ** 2).alias("n2"))
    rate = F.least(F.greatest(F.col("s") / F.col("n"), F.lit(1e-6)), F.lit(1 - 1e-6))
    m = each.agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("spread"),
                 F.sum((F.col("k") - 1) * rate * (1 - rate)).alias("noise"), F.sum(F.col("k") - 1).alias("free"),
                 F.sum(F.col("n") - F.col("n2") / F.col("n")).alias("size")).first()
    if not m.free or m.size <= 0:  # no host has two paths
        return 100.0
    between = (m.spread - m.noise) / m.size
    return float(min(max(m.noise / m.free / between - 1, 1.0), 1e6)) if between > 0 else 1e6


def keep_good(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``df`` without the rejected rows; all columns stay."""
    return without(df, classify(df, labels).where(~F.col("keep")))
