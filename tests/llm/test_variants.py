"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from martlake.llm import variants


def brute(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    out = {}
    for w, k in n.items():
        close = [x for x in n if x != w and near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        out[w] = (best if best is not None and n[best] >= 10 * k else None, k, len(close))
    full = set()
    for w, (form, k, close) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        full.add((w, form, root, k, close, n[form] if form else None))
    return full


def rows():
    rnd = random.Random(7)
    syl = ["ba", "na", "que", "él", "ç", "st", "ou", "Ér", "mo", "ti"]
    base = ["".join(rnd.choice(syl) for _ in range(rnd.randint(3, 7))) for _ in range(60)]

    def edited(w):
        p = rnd.randrange(len(w))
        return rnd.choice([w[:p] + w[p + 1:], w[:p] + "x" + w[p:], w[:p] + rnd.choice("abcß÷") + w[p + 1:]])
    out = []
    for i in range(400):
        w = [base[int(rnd.random() ** 3 * len(base))] for _ in range(60)]
        w = [edited(x) if rnd.random() < 0.08 else x for x in w]
        out.append((i, rnd.choice([" ", ", ", "-"]).join(w)))
    long = "ab" * 6000
    return [*out, (400, None), (401, ""), (None, " ".join(base[:30]).upper()), (5, out[5][1]), (402, f"{long} {long[:-1]}c x {long}a"),
            (403, f"{long} {long[:-1]}c {long}a"), (404, "Internation internation Internationa INTERNATION œuvrement œuvrement")]


@pytest.mark.parametrize("block", [4, 512])
def test_spelling_variants(spark, block):
    given = rows()
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in given], "doc_id long, text string, word string, n int, near string").repartition(3)
    got = [tuple(r) for r in variants.spelling_variants(df, block=block).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute(given)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != r[0] and r[2] != r[1] for r in want)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.spelling_variants(empty).count() == 0
    assert variants.spelling_variants(spark.createDataFrame([(1, None), (2, "single words")], "doc_id long, text string")).count() == 0


def test_checksums_combine():
    import numpy as np
    ahead = variants._shifted(np.array([zlib.crc32(b"123:")], np.uint32))
    for w in (b"", b"a", b"abc\xc3\xa9", b"z" * variants.SHORT):
        assert int(ahead[len(w), 0]) ^ zlib.crc32(w) == zlib.crc32(b"123:" + w)
