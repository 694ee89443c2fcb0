"""Prefix trie of conversations by sorted sequences and range minima of their LCPs.

1. ``rebuilt`` streams each family of conversations (ids c - c%20 .. ) once and gives
   every conversation as the chain of its prefixes' digests: digest d hashes digest
   d-1 and turn d, so equal digests mean equal prefixes. Texts aren't carried.
2. Equal sequences become one row with their number and smallest id. The distinct
   sequences are sorted by range; a range also gets the first row of the next one
   (``sentinel``), so that every row knows what it shares with both neighbours.
3. A range is worked off in blocks of sorted rows (``Block``). The longest common
   prefixes (LCPs) of neighbours go into a sparse table of range minima. Each
   distinct prefix in the block is a candidate and finds the left and the right
   end of its members by binary search over that table, on its own; no stack.
   Everything asked for is a sum or a minimum over that interval.
4. A node whose interval touches a block's edge has parts in several blocks (the
   ones on the path to the edge). Parts are added up by a group by with partial
   sums, so a prefix of a third of all rows is a few rows a block. All other
   nodes are complete within their block.

Sums over a node's subtree, from its interval alone. Let row i bring the nodes
deeper than the LCP with row i-1. A subtree's distinct nodes are those brought by
its rows, from the node's own depth on; leaves are rows that the next row doesn't
go on from; a row brings a child of a node when its LCP is at most the node's depth.
The first row of a range counts as bringing all of its path; the range before, which
holds that row as sentinel, takes back what it shares.

A conversation's digests and token counts (24 bytes a turn) are held as one row.
SHA-256 can't be split: the ids that end at one node are hashed by one task, as a
stream in sorted order.

Defined cases: null role or text is empty; null turns come first; turns of equal
number are ordered by the digest of role and text; repeated rows are turns each;
rows without conv_id belong to no conversation; conv_id % 20 is the remainder
with the sign of conv_id; an empty table has no node.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.text import saved

FAMILY = 20
ROOT = bytes(16)
WIDTH = 16  # bytes of a digest
BLOCK_ROWS, BLOCK_TURNS = 8192, 1 << 17
SALTS = 32
NO_IDS = hashlib.sha256(b"").hexdigest()


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(family, own, conv_id, turn, digest, words) of every row with a conv_id."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    conv = F.col(f"`{conv_col}`").cast("long")
    family = conv - conv % FAMILY
    return df.where(conv.isNotNull()).select(
        family.alias("family"), (conv != family).alias("own"), conv.alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


REBUILT = pa.schema([("conv_id", pa.int64()), ("node", pa.binary()), ("path", pa.binary()), ("words", pa.binary())])


def rebuilt(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, node, path, words): each rebuilt conversation's last node, the digests
    of all its prefixes and the words of its turns."""
    def run(it):
        family, head, conv, mine, skip = None, [], None, [], 0
        rows = []

        def start(c, f):
            nonlocal family, head, conv, mine, skip
            if f != family:
                family, head = f, []
            conv, skip = c, zlib.crc32(b"%d" % c) % 4
            mine = list(head[:skip]) if c != f else []

        def close():
            chain, path = ROOT, []
            for d, _ in mine:
                chain = hashlib.md5(chain + d, usedforsecurity=False).digest()
                path.append(chain)
            rows.append((conv, chain, b"".join(path), np.array([n for _, n in mine], "<i8").tobytes()))

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), REBUILT.types, strict=True)],
                                             schema=REBUILT)
            rows.clear()
            return out

        for b in it:
            for f, c, d, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if c != conv:
                    if conv is not None:
                        close()
                    start(c, f)
                if c == family:  # the family's first conversation: it is its own start
                    if len(head) < 3:
                        head.append((d, n))
                    mine.append((d, n))
                elif skip:
                    skip -= 1
                else:
                    mine.append((d, n))
            if rows:
                yield batch()
        if conv is not None:
            close()
            yield batch()

    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    return turns.repartition("family").sortWithinPartitions("family", "own", "conv_id", F.col("turn").asc_nulls_first(), "digest") \
        .select("family", "conv_id", "digest", "words").mapInArrow(run, "conv_id long, node binary, path binary, words binary")


class Block:
    """Neighbouring sorted sequences. ``lcp[i]``: turns that row i shares with the row
    before it; ``lcp[rows]``: the last row with the one behind the block."""

    def __init__(self, size: np.ndarray, lcp: np.ndarray):
        self.size, self.lcp, self.rows = size, lcp, len(size)
        self.table = [lcp[1:-1] if len(size) > 1 else np.zeros(0, np.int64)]  # [k][i]: minimum of 2^k LCPs from the pair (i, i+1)
        while (1 << len(self.table)) <= len(self.table[0]):
            half = 1 << (len(self.table) - 1)
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def extents(self, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row that share the first ``depth`` turns with ``row``: two
        binary searches of each candidate, from the widest range minimum down."""
        left, right = row.copy(), row.copy()
        for k in range(len(self.table) - 1, -1, -1):
            low, width = self.table[k], 1 << k
            ok = right + width < self.rows
            ok[ok] = low[right[ok]] >= depth[ok]
            right[ok] += width
            ok = left >= width
            ok[ok] = low[left[ok] - width] >= depth[ok]
            left[ok] -= width
        return left, right


def _range_min(x: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Minimum of x[a..z] (both included)."""
    table = [x]
    while 2 << (len(table) - 1) <= len(x):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.floor(np.log2(z - a + 1)).astype(np.int64)
    out = np.empty(len(a), x.dtype)
    for k in np.unique(level).tolist():
        at = level == k
        out[at] = np.minimum(table[k][a[at]], table[k][z[at] - (1 << k) + 1])
    return out


PART = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                  ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
                  ("whole", pa.bool_()), ("parent_conv_id", pa.int64())])
PART_DDL = ("node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
            "whole boolean, parent_conv_id long")


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two sequences share."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    x, y = (np.frombuffer(p, "V16", n) for p in (a, b))
    return int((x != y).argmax())


class Rows:
    """Sorted sequences that wait for the next row: path, words, conversations, smallest id."""

    def __init__(self):
        self.path: list[bytes] = []
        self.words: list[bytes] = []
        self.n: list[int] = []
        self.least: list[int] = []
        self.turns = 0

    def add(self, path: bytes, words: bytes, n: int, least: int) -> None:
        self.path.append(path)
        self.words.append(words)
        self.n.append(n)
        self.least.append(least)
        self.turns += len(path) // WIDTH


def block_nodes(rows: Rows, before: int | None, after: int) -> pa.RecordBatch:
    """What a block knows of each of its prefixes. ``before``: turns that its first row
    shares with the row before it (None at the start of a range: not known, the
    row counts as bringing all of its path); ``after``: its last row with the
    next one (-1: there is none)."""
    unknown, before = before is None, before or 0
    size = np.array([len(p) // WIDTH for p in rows.path], np.int64)
    lcp = np.array([before, *(_shared(a, b) for a, b in zip(rows.path, rows.path[1:], strict=False)), after], np.int64)
    n, least = np.array(rows.n, np.int64), np.array(rows.least, np.int64)
    block = Block(size, lcp)
    # words: flat, with the sum of all turns of a row before a place in it
    flat = np.frombuffer(b"".join(rows.words), "<i8")
    upto = np.concatenate([[0], np.cumsum(flat)])
    begin = np.cumsum(size) - size
    total = upto[begin + size] - upto[begin]

    def behind(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words of a row's turns after the first ``depth``."""
        return upto[(begin + size)[row]] - upto[begin[row] + np.minimum(depth, size[row])]

    every = np.arange(len(size))
    brings = behind(every, lcp[:-1])  # words of the nodes that a row brings
    leaf = (lcp[1:] < size).astype(np.int64)
    sums = {k: np.concatenate([[0], np.cumsum(v)]) for k, v in
            {"n": n, "leaf": leaf, "brings": brings, "all": n * total}.items()}

    # candidates: the root, and each prefix at the first row of the block that has it
    local = lcp[:-1].copy()
    local[0] = 0
    own = size - local
    row = np.concatenate([[0], np.repeat(every, own)])
    depth = np.concatenate([[0], np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own) + np.repeat(local, own) + 1])
    left, right = block.extents(row, depth)

    def over(k: str) -> np.ndarray:
        return sums[k][right + 1] - sums[k][left]
    # what members share above the node costs nothing below it
    above = upto[begin[row] + np.maximum(depth - 1, 0)] - upto[begin[row]]
    tokens = over("all") - over("n") * above
    # nodes brought from the node's own depth on: the first row brings no more than that
    top = np.maximum(depth - 1, 0)
    inside = over("brings") - brings[left] + behind(left, np.maximum(lcp[left], top))
    # children: rows behind the first that share just the node and go on, and the first row's own
    bring_at = _at_depth(lcp, size, left, right, depth)
    goes_on = (size[left] > depth) & (lcp[left] <= depth)
    edge = ((left == 0) & (unknown | (lcp[0] >= depth))) | ((right == len(size) - 1) & (lcp[-1] >= depth))
    edge |= depth == 0
    conv = _range_min(least, left, right)
    path = b"".join(rows.path)
    ids = np.frombuffer(ROOT + path, "V16")
    at = np.where(depth == 0, 0, begin[row] + depth)  # 0: the root
    up = np.where(depth <= 1, 0, at - 1)
    # a node's parent within the block: the same interval search, one turn shorter
    pl, pr = block.extents(row, np.maximum(depth - 1, 0))
    parent_edge = (depth <= 1) | ((pl == 0) & (unknown | (lcp[0] >= depth - 1))) | ((pr == len(size) - 1) & (lcp[-1] >= depth - 1))
    parent = pa.array(_range_min(least, pl, pr), pa.int64(), mask=edge | parent_edge)
    cell = pa.binary(WIDTH)
    return pa.RecordBatch.from_arrays([
        pa.array(ids[at].tolist(), cell).cast(pa.binary()), pa.array(ids[up].tolist(), cell).cast(pa.binary()), pa.array(depth),
        pa.array(conv), pa.array(over("n")), pa.array(bring_at + goes_on), pa.array(over("leaf")), pa.array(tokens - inside),
        pa.array(~edge), parent], schema=PART)


def _at_depth(lcp: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Rows in left+1..right whose LCP with the row before is ``depth`` and that are
    longer: each brings one child of the node."""
    at = np.flatnonzero(size > lcp[:-1])
    order = np.lexsort((at, lcp[at]))
    rows = len(size) + 1
    key = lcp[at][order] * rows + at[order]
    return np.searchsorted(key, depth * rows + right, "right") - np.searchsorted(key, depth * rows + left, "right")


def taken_back(path: bytes, words: bytes, shared: int) -> pa.RecordBatch:
    """What the first row of the next range counts as brought although the row before
    has it: its first ``shared`` nodes, for each node above them and themselves."""
    n = np.frombuffer(words, "<i8")[:shared]
    ids = [ROOT, *(path[i * WIDTH: (i + 1) * WIDTH] for i in range(shared))]
    depth = np.arange(shared + 1)
    below = np.cumsum(np.concatenate([n, [0]])[::-1])[::-1]  # words of the turns after the first d of the shared ones
    own = below[np.maximum(depth - 1, 0)]
    zero = np.zeros(shared + 1, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.binary()), pa.array([ROOT, *ids[:-1]], pa.binary()), pa.array(depth),
        pa.nulls(shared + 1, pa.int64()), pa.array(zero), pa.array(-(depth < shared).astype(np.int64)), pa.array(zero),
        pa.array(own), pa.array(zero.astype(bool)), pa.nulls(shared + 1, pa.int64())], schema=PART)


def trie_parts(sequences: DataFrame, block_rows: int, block_turns: int) -> DataFrame:
    """Nodes and parts of nodes (``PART``) of distinct sequences (path, words, n, least),
    from blocks of about so many rows or turns at most."""
    spark = sequences.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = saved(sequences.repartitionByRange(ranges, "path").withColumn("part", F.spark_partition_id()), "trie-sorted")
    # the first row of each range goes to the range before it, too (one row a range)
    firsts = sorted_.groupBy("part").agg(F.min("path").alias("path"))
    order = sorted(r.part for r in firsts.select("part").collect())  # at most the number of shuffle partitions
    before = spark.createDataFrame(list(zip(order[1:], order, strict=False)), "part int, before int")
    sentinels = sorted_.join(firsts, ["part", "path"], "left_semi").join(before, "part") \
        .select("path", "words", "n", "least", F.col("before").alias("part"), F.lit(True).alias("sentinel"))
    rows = sorted_.withColumn("sentinel", F.lit(False)).unionByName(sentinels)

    def run(it):
        rows, before, part, last = Rows(), None, None, b""

        def finished(after: int):
            nonlocal rows, before
            out = block_nodes(rows, before, after)
            rows, before = Rows(), after
            return out

        for b in it:
            for path, words, n, least, p, sentinel in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if sentinel:  # the last row of its range
                    shared = _shared(last, path)
                    yield finished(shared)
                    yield taken_back(path, words, shared)
                    continue
                if p != part:
                    if rows.path:
                        yield finished(-1)
                    rows, before, part = Rows(), None, p
                elif len(rows.path) >= block_rows or rows.turns >= block_turns:
                    yield finished(_shared(last, path))
                rows.add(path, words, n, least)
                last = path
        if rows.path:
            yield finished(-1)

    return rows.repartition("part").sortWithinPartitions("part", "path", "sentinel") \
        .select("path", "words", "n", "least", "part", "sentinel").mapInArrow(run, PART_DDL)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the ids (ascending, comma-joined) that end at
    each node, hashed as a stream."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(it):
        node, state = None, None
        for b in it:
            done = []
            ids, nodes = b.column(1).to_pylist(), b.column(0).to_pylist()
            lo = 0
            for i in range(1, len(nodes) + 1):
                if i < len(nodes) and nodes[i] == nodes[lo]:
                    continue
                text = ",".join(map(str, ids[lo:i])).encode()
                if nodes[lo] == node:
                    state.update(b"," + text)
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = nodes[lo], hashlib.sha256(text)
                lo = i
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    return ends.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id") \
        .mapInArrow(run, "node binary, ends_sha256 string")


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) of every node."""
    convs = saved(rebuilt(df, conv_col, turn_col, role_col, text_col), "trie-rebuilt")
    sequences = convs.groupBy("node").agg(F.first("path").alias("path"), F.first("words").alias("words"),
                                          F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).drop("node")
    parts = saved(trie_parts(sequences, block_rows, block_turns), "trie-parts")
    open_ = parts.where(~F.col("whole")).groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")))
    nodes = parts.where("whole").select("node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "parent_conv_id") \
        .unionByName(saved(open_.withColumn("parent_conv_id", F.lit(None).cast("long")), "trie-open"))
    # parents that have parts in several blocks: few, but some with many children, so they are salted
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    above = parts.where(~F.col("whole") & F.col("conv_id").isNotNull()).groupBy("node").agg(F.min("conv_id").alias("above")) \
        .select(F.col("node").alias("parent"), "above", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    asks = (F.col("parent_conv_id").isNull()) & (F.col("depth") > 0)
    found = nodes.where(asks).withColumn("salt", salt).join(above, ["parent", "salt"]) \
        .withColumn("parent_conv_id", F.col("above")).drop("salt", "above")
    nodes = nodes.where(~asks).unionByName(found.select(nodes.columns))
    return nodes.join(end_hashes(convs), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"))
