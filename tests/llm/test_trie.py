"""The conversation trie against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from martlake.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(x, key=lambda x: x[0])] for c, x in own.items()}
    full = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        start = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = tuple(own.get(start, [])[:h] + x[h:])
    members, ends = {}, {}
    for c, x in full.items():
        for d in range(len(x) + 1):
            members.setdefault(x[:d], []).append(c)
        ends.setdefault(x, []).append(c)
    children = {}
    for x in members:
        if x:
            children.setdefault(x[:-1], []).append(x)
    leaves, saved = {}, {}
    for x in sorted(members, key=len, reverse=True):
        kids = children.get(x, [])
        leaves[x] = sum(leaves[k] for k in kids) if kids else 1
        here = (len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        saved[x] = here + sum(saved[k] for k in kids)
    return sorted(((min(m), len(x), min(members[x[:-1]]) if x else None, len(m), len(children.get(x, [])), leaves[x], saved[x],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(x, [])))).encode()).hexdigest()) for x, m in members.items()), key=str)


def conversations(seed, convs=150, kinds=3, longest=7):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(convs * 2), convs):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, t, rnd.choice(["user", "user", "bot", None]), rnd.choice(["a b", "a  b c\n d", None, "é x", ""][:kinds])))
    rows += [(900, t, "user", f"turn {t}") for t in range(300)]  # one long conversation and copies of it
    rows += [(c, t, "user", f"turn {t}") for c in range(920, 930) for t in range(200)]
    rows += [(1000 + c, t, "user", "same words here") for c in range(0, 400, 20) for t in range(4)]  # exact copies
    return [*rows, (None, 1, "user", "lost"), (3, None, "user", "first"), (3, 5, "user", "tie"), (3, 5, "user", "tie"), (3, 5, "bot", "tie"),
            (-7, 0, "user", "a b"), (-20, 0, "user", "a b"), (-21, 0, "user", "a b"), (-21, 1, "bot", "q"), (2001, 0, "user", "alone")]


@pytest.mark.parametrize(("rows", "turns"), [(8192, 1 << 17), (5, 40)])
def test_trie(spark, rows, turns):
    given = conversations(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in given], "conv_id long, turn long, role string, text string, node int, path string").repartition(3)
    got = trie.conversation_trie(df, block_rows=rows, block_turns=turns).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(given)


def test_small_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    for given in ([(21, 0, "user", "x")], [(2, 0, "u", "hi")], [(c, 0, None, None) for c in range(40)]):
        got = sorted((tuple(r) for r in trie.conversation_trie(spark.createDataFrame(given, schema)).select(*COLUMNS).collect()), key=str)
        assert got == brute(given)


def test_extents_are_those_of_a_scan():
    rnd = np.random.default_rng(3)
    for rows in (1, 2, 3, 7, 64, 65):
        lcp = rnd.integers(0, 4, rows + 1)
        block = trie.Block(np.full(rows, 4), lcp)
        row, depth = (a.ravel() for a in np.meshgrid(np.arange(rows), np.arange(5)))
        left, right = block.extents(row, depth)
        for r, d, a, z in zip(row, depth, left, right, strict=True):
            x = y = r
            while x > 0 and lcp[x] >= d:
                x -= 1
            while y < rows - 1 and lcp[y + 1] >= d:
                y += 1
            assert (a, z) == (x, y)
