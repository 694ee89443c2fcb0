"""N-gram Jaccard self-join with vertical partitioning.

Every document is the set of its distinct word n-grams. The n-grams have one
global order, rare ones first, and that order is cut into ``fragments``. The
overlap of two documents is counted separately in each fragment and summed per
pair; a pair is a link when ``100 * overlap >= percent * union`` (integers).

How pairs are found, without emitting all pairs of a group:

1. ``word_levels`` counts words in a sketch of fixed size (2^22 counters). The
   order key of an n-gram is the sum of its words' log counts, then its hash.
   Only the order depends on the sketch, never a result.
2. Documents with equal sets collapse into one class (digest of the set).
3. A class emits its first n-grams in the global order, so many that two linked
   classes must share at least ``need`` of them. N-grams of a single class go.
4. *Stars*: in every n-gram's bucket the classes are compared with two of them
   only, the smallest and the most central one (the largest part of its first
   n-grams is shared: the least edited copy). Confirmed links give components.
5. *Rest*: classes of different components that share ``need`` such n-grams are
   compared in full. A pair inside a component can't change it, and every other
   possible link is tested, so components are exact and no case is capped.
   Buckets whose classes are all of one component go before that.
6. Before a comparison, parity sketches of both sets (``ODD_BITS`` bits) bound the
   size of their symmetric difference from below; pairs that can't be links go
   inside the join, before they are a row.

Defined cases: null text = no words; a document with fewer words than n has its
whole word sequence as one n-gram; without words it is linked with nothing and
is its own component; equal ids are one document; a row without doc_id joins the
component of its equal set (null when all of its set have no id).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.components import components
from martlake.llm.text import (LOWER, PART_DDL, PART_VALUES, PARTS, SPACED, U64, blocks, bloom_bits, bloom_has, gram_hashes,
                               in_parts, keyed, may_repeat, merged, removed, repeat_answers, saved, word_hashes, word_spans)

SKETCH_BITS = 22
SHARED = 3  # n-grams of the prefixes that a link must share
BLOCK = 1 << 17  # first n-grams in a block of classes, about


def _words(data: np.ndarray, off: np.ndarray):
    data = LOWER[data]
    starts, ends, first = word_spans(data, off, SPACED)
    return word_hashes(data, starts, ends), first


def word_levels(docs: DataFrame) -> np.ndarray:
    """log2 of the number of words that fall on each of 2^22 counters.

    Every task counts for itself; the counters are added up in the tasks, so that
    one array of fixed size reaches the driver.
    """
    def count(it):
        total = np.zeros((1, 1 << SKETCH_BITS), np.int64)
        for b in it:
            for _, _, data, off in blocks(b.column(0)):
                h, _ = _words(data, off)
                np.add.at(total[0], (h >> U64(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield in_parts(total)

    def add(total, more):
        total += more

    total = merged(docs.select("text").mapInArrow(count, PART_DDL), np.zeros((1, 1 << SKETCH_BITS), np.int64), add)
    return np.log2(total[0] + 1.0).astype(np.uint8)


def order_keys(h: np.ndarray, first: np.ndarray, n: int, levels: np.ndarray) -> list[np.ndarray]:
    """Per document: its distinct n-grams as order keys (rarity, then hash), ascending."""
    lev = levels[(h >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)
    grams = gram_hashes(h, n)
    run = np.concatenate([[0], np.cumsum(lev)])
    rank = np.minimum((run[n:] - run[:-n]) * 3 // n, 126) if len(grams) else np.zeros(0, np.int64)
    keys = (rank.astype(U64) << U64(56)) | (grams >> U64(8))
    out = []
    for d in range(len(first) - 1):
        lo, hi = int(first[d]), int(first[d + 1])
        if hi - lo >= n:
            out.append(np.unique(keys[lo: hi - n + 1]))
        elif hi > lo:
            one = gram_hashes(h[lo:hi], hi - lo)  # the hash also holds the number of words
            out.append((U64(0) << U64(56)) | (one >> U64(8)))
        else:
            out.append(np.zeros(0, U64))
    return out


def _digest(keys: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(keys.tobytes(), usedforsecurity=False).digest()[:8], "little", signed=True)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, U64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.view(np.int64)))


def _longs(n) -> Column:
    return F.lit(n).cast("long")


ODD_BITS = 512


def odd_sketch(keys: np.ndarray) -> np.ndarray:
    """Bit b: the number of order keys whose hash falls on b is odd. Every key that
    only one of two sets has flips one bit, so the number of bits in which two
    sketches differ is at most the size of the symmetric difference."""
    counts = np.bincount(((keys >> U64(46)) & U64(ODD_BITS - 1)).astype(np.int64), minlength=ODD_BITS)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def may_link(na: str, nb: str, odd_a: str, odd_b: str, percent: int) -> Column:
    """False only where the sketches prove that the pair is no link:
    100 * overlap >= percent * union means (100 + percent) * difference <= (100 - percent) * (na + nb)."""
    apart = sum((F.bit_count(F.col(odd_a)[i].bitwiseXOR(F.col(odd_b)[i])) for i in range(ODD_BITS // 64)), F.lit(0))
    return apart * (100 + percent) <= (F.col(na) + F.col(nb)) * (100 - percent)


def class_rows(docs: DataFrame, n: int, percent: int, levels) -> DataFrame:
    """(doc_id, fp, n_shingles, cls, prefix, odd): the set's size, its digest, its first
    ``size - ceil(percent% of size) + SHARED`` order keys and its parity sketch."""
    def run(it):
        lev = levels.value
        for b in it:
            for lo, hi, data, off in blocks(b.column(2)):
                sets = order_keys(*_words(data, off), n, lev)
                sizes = [len(k) for k in sets]
                cut = [k[: len(k) + (-percent * len(k) // 100) + SHARED] for k in sets]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                    pa.array([_digest(k) if len(k) else None for k in sets], pa.int64()), _lists(cut),
                    _lists([odd_sketch(k) for k in sets])],
                    ["doc_id", "fp", "n_shingles", "cls", "prefix", "odd"])
    return docs.select("doc_id", "fp", "text") \
        .mapInArrow(run, "doc_id long, fp long, n_shingles long, cls long, prefix array<long>, odd array<long>")


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches still allow a link."""
    sa, sb = (sketches.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"odd{x}"))
              for x in ("a", "b"))
    return pairs.join(sa, "a").join(sb, "b").where(may_link("na", "nb", "odda", "oddb", percent)).select("a", "b")


def gram_blocks(classes: DataFrame) -> DataFrame:
    """(block, cls, n, size, gram): whole classes with the numbers and, one after the other,
    their first n-grams, about ``BLOCK`` in a row (a longer class alone); a block is known
    by its first class."""
    def run(it):
        for b in it:
            cls, n, lists = (b.column(i) for i in range(3))
            off, lo = lists.offsets.to_numpy().astype(np.int64), 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BLOCK, "right")) - 1)
                part = slice(lo, hi)
                gram = lists.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [cls[lo: lo + 1], *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t)) for x, t in (
                        (cls.to_numpy()[part], pa.int64()), (n.to_numpy()[part], pa.int64()), (np.diff(off[lo: hi + 1]), pa.int32()),
                        (gram, pa.int64())))], ["block", "cls", "n", "size", "gram"])
                lo = hi
    return classes.select("cls", "n", "prefix") \
        .mapInArrow(run, "block long, cls array<long>, n array<long>, size array<int>, gram array<long>")


def repeated_grams(classes: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """(cls, n, gram, central) of the classes' first n-grams, almost without those
    that only one class has (``repeat_answers``, whose share of single ones that pass
    doesn't depend on the table's size); the joins behind are exact. ``central``: the
    part of the class's first n-grams that stayed."""
    asked: list[str] = []
    grams = classes.agg(F.sum(F.size("prefix").cast("long"))).first()[0] or 0
    parts = max(PARTS, grams // PART_VALUES)
    packed = saved(gram_blocks(classes), "blocks", asked)

    def run(it):
        for b in it:
            for i in range(b.num_rows):
                cls, n, size, gram = (b.column(k)[i].values.to_numpy(zero_copy_only=False) for k in range(4))
                found = b.column(4)[i].values
                keep = may_repeat(gram, parts, dict(zip(found.field("part").to_pylist(), found.field("raw").to_pylist(), strict=True)))
                row = np.repeat(np.arange(len(cls)), size)
                central = np.bincount(row[keep], minlength=len(cls)) / np.maximum(size, 1)
                row = row[keep]
                yield pa.RecordBatch.from_arrays([pa.array(cls[row]), pa.array(n[row]), pa.array(gram[keep]), pa.array(central[row])],
                                                 ["cls", "n", "gram", "central"])

    given = repeat_answers(packed, "gram", parts).groupBy("block").agg(F.collect_list(F.struct("part", "raw")).alias("found"))
    kept = saved(packed.join(given, "block").select("cls", "n", "size", "gram", "found")
                 .mapInArrow(run, "cls long, n long, gram long, central double"), "first-grams", paths)
    removed(classes.sparkSession, asked)
    return kept


def _of_classes(docs: DataFrame, ids: DataFrame, n: int, levels, row, schema: pa.Schema, ddl: str) -> DataFrame:
    """``row(keys)`` of the sets of the documents in ``ids`` (cls, doc_id). A bitmap of
    fixed size drops most other texts before they are read; the few that pass are
    not asked for later (a class may appear twice, always with the same rows)."""
    seen = docs.sparkSession.sparkContext.broadcast(bloom_bits(ids, "doc_id"))

    def run(it):
        lev = levels.value
        for b in it:
            keep = np.zeros(b.num_rows, bool)
            valid = ~b.column(0).is_null().to_numpy(zero_copy_only=False)
            keep[valid] = bloom_has(seen.value, b.column(0).drop_null().to_numpy(zero_copy_only=False))
            for _, _, data, off in blocks(b.filter(pa.array(keep)).column(1)):
                out = [r for keys in order_keys(*_words(data, off), n, lev) if len(keys) for r in row(keys)]
                cols = list(zip(*out, strict=True)) if out else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def segments(docs: DataFrame, ids: DataFrame, n: int, levels, fragments: int) -> DataFrame:
    """(cls, f, keys) of the classes in ``ids``: a set's order keys cut at the global
    order's pivots."""
    def row(keys: np.ndarray) -> list[tuple]:
        cls, cuts = _digest(keys), np.searchsorted(_fragment(keys, fragments), np.arange(fragments + 1))
        return [(cls, i, keys[x:y].view(np.int64)) for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x]
    return _of_classes(docs, ids, n, levels, row,
                       pa.schema([("cls", pa.int64()), ("f", pa.int32()), ("keys", pa.list_(pa.int64()))]),
                       "cls long, f int, keys array<long>")


def _fragment(keys: np.ndarray, fragments: int) -> np.ndarray:
    """Fragment of ascending order keys: pivots split the rarity ranks evenly,
    the last one takes all frequent n-grams (the result is ascending)."""
    rank = (keys >> U64(56)).astype(np.int64)
    return np.minimum(rank * fragments // 64, fragments - 1)


def confirmed(pairs: DataFrame, segs: DataFrame, sizes: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, b) that are links: partial overlaps by fragment, summed."""
    each = pairs.select("a", "b", F.explode(F.array(*[F.lit(i) for i in range(fragments)])).alias("f"))
    left = segs.select(F.col("cls").alias("a"), "f", F.col("keys").alias("ka"))
    right = segs.select(F.col("cls").alias("b"), "f", F.col("keys").alias("kb"))
    partial = each.join(left, ["a", "f"]).join(right, ["b", "f"]) \
        .select("a", "b", "f", F.size(F.array_intersect("ka", "kb")).alias("part")) \
        .groupBy("a", "b", "f").agg(F.max("part").alias("part"))
    sa, sb = (sizes.select(F.col("cls").alias(x), F.col("n").alias(f"n{x}")) for x in ("a", "b"))
    both = partial.groupBy("a", "b").agg(F.sum("part").alias("overlap")).join(sa, "a").join(sb, "b")
    return both.where(F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * percent) \
        .select("a", "b")


def linked_classes(docs: DataFrame, n: int, percent: int, fragments: int,
                   paths: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, components) of ``docs`` (doc_id, fp, text): (doc_id, fp, n_shingles,
    cls) of every row, (cls, doc_id, ...) of the distinct sets, (node, component) of
    the classes that have a link. Rows without doc_id make no class. ``paths`` gets
    the paths of the three; what else is saved on the way goes as soon as it is used."""
    spark = docs.sparkSession
    paths = [] if paths is None else paths
    whole: list[str] = []  # what the next result replaces
    work: list[str] = []
    levels = spark.sparkContext.broadcast(word_levels(docs))
    sets = saved(class_rows(docs, n, percent, levels), "sets", whole)
    rows = saved(sets.select("doc_id", "fp", "n_shingles", "cls"), "rows", paths)
    full = saved(sets.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull())
                 .groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
                                     F.first("prefix").alias("prefix"), F.first("odd").alias("odd")), "classes", work)
    removed(spark, whole)
    classes = saved(full.drop("prefix"), "classes", paths)
    sizes, sketches = classes.select("cls", "n"), classes.select("cls", "n", "odd")
    prefix = repeated_grams(full, whole)
    removed(spark, work)
    stars = prefix.groupBy("gram").agg(F.min("cls").alias("low"), F.max("cls").alias("high"),
                                       F.max(F.struct("central", "cls"))["cls"].alias("centre")) \
        .where(F.col("low") != F.col("high")).drop("high")
    shared = saved(prefix.drop("central").join(stars, "gram"), "shared", work)
    removed(spark, whole)

    def fits(x: str, y: str) -> Column:
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    def pair(x: str, y: str) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    hubs = shared.select(F.col("low").alias("hub"), "cls", "n") \
        .unionAll(shared.select(F.col("centre").alias("hub"), "cls", "n")).where(F.col("hub") != F.col("cls"))
    star = hubs.groupBy("hub", "cls", "n").agg(F.count(F.lit(1)).alias("k")) \
        .join(sizes.select(F.col("cls").alias("hub"), F.col("n").alias("nh")), "hub") \
        .where(fits("n", "nh") & (F.col("k") >= F.least(_longs(SHARED), "n", "nh"))) \
        .select(*pair("hub", "cls")).distinct()

    def links_of(pairs: DataFrame) -> DataFrame:
        near = saved(possible(pairs, sketches, percent), "near", whole)
        ends = near.select(F.col("a").alias("cls")).unionAll(near.select(F.col("b").alias("cls"))).distinct()
        segs = saved(segments(docs, classes.select("cls", "doc_id").join(ends, "cls"), n, levels, fragments), "segments", whole)
        links = saved(confirmed(near, segs, sizes, percent, fragments), "links", work)
        removed(spark, whole)
        return links

    links = links_of(star)
    joined = components(links, paths=work)

    open_ = shared.select("gram", "cls", "n").join(joined.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("gram", "cls", "n", F.coalesce("component", "cls").alias("comp"))
    mixed = open_.groupBy("gram").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where(F.col("x") != F.col("y"))
    open_ = open_.join(mixed.select("gram"), "gram", "left_semi")
    enough = open_.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("k")) \
        .where(F.col("k") >= F.least(_longs(SHARED), _least_overlap("n", percent))).select("cls")
    left = saved(open_.join(enough.join(sketches.select("cls", "odd"), "cls"), "cls"), "rest", work) \
        .select("gram", "cls", "n", "comp", "odd")
    right = left.toDF("gram2", "cls2", "n2", "comp2", "odd2")
    both = left.join(right, (F.col("gram") == F.col("gram2")) & (F.col("cls") < F.col("cls2"))
                     & (F.col("comp") != F.col("comp2")) & fits("n", "n2")
                     & may_link("n", "n2", "odd", "odd2", percent)) \
        .groupBy("cls", "cls2", "n", "n2").agg(F.count(F.lit(1)).alias("k")) \
        .where(F.col("k") >= F.least(_longs(SHARED), F.greatest(_least_overlap("n", percent), _least_overlap("n2", percent))))
    rest = both.select(F.col("cls").alias("a"), F.col("cls2").alias("b"))
    final = saved(components(links.unionAll(links_of(rest)), paths=work), "components", paths)
    removed(spark, work)
    return rows, classes, final


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, percent: int = 90,
                    fragments: int = 8) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``df``."""
    rows, classes, final = linked_classes(keyed(df, id_col, text_col), n, percent, fragments)
    ids = classes.select("cls", "doc_id").join(final.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("cls", "doc_id", F.coalesce("component", "cls").alias("comp"))
    least = ids.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    label = ids.join(least, "comp").select("cls", "component_id")
    return rows.select("doc_id", "n_shingles", "cls").join(label, "cls", "left") \
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _least_overlap(n: str, percent: int) -> Column:
    """ceil(percent% of n)"""
    return F.ceil(F.col(n) * percent / F.lit(100)).cast("long")


def keep_one(df: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each component; all columns stay.

    A row is known by its id and its text, so different texts under one id are
    judged each on its own. The row that stays has the smallest id of its component
    (rows without an id come last), then the smallest hash of its text; of rows equal
    in both, the one with the smallest hash of all columns. Rows without words are
    linked with nothing and stay.
    """
    keyed_rows = keyed(df)
    # rows without an id take part under the hash of their text, which is no id of the result
    docs = keyed_rows.withColumn("doc_id", F.coalesce("doc_id", "fp"))
    paths: list[str] = []
    rows, _, final = linked_classes(docs, n, percent, 8, paths)
    lone = keyed_rows.where(F.col("doc_id").isNull()).select("fp").distinct().withColumn("lone", F.lit(True))
    member = rows.where(F.col("cls").isNotNull()).select("doc_id", "fp", "cls") \
        .join(final.withColumnRenamed("node", "cls"), "cls", "left").join(lone, "fp", "left") \
        .select(F.coalesce("component", "cls").alias("comp"), "fp", "doc_id",
                (F.col("lone").isNotNull() & (F.col("doc_id") == F.col("fp"))).alias("lone"))
    same = member.groupBy("comp", "lone", "doc_id", "fp").agg(F.count(F.lit(1)).alias("n"))
    first = same.groupBy("comp").agg(F.min(F.struct("lone", "doc_id", "fp", "n")).alias("first")).select("first.*")
    bare = rows.where(F.col("n_shingles") == 0).select("doc_id", "fp").distinct().join(lone, "fp", "left") \
        .select(F.col("lone").isNotNull() & (F.col("doc_id") == F.col("fp")), "doc_id", "fp", F.lit(1)).toDF("lone", "doc_id", "fp", "n")
    stays = saved(first.unionByName(bare).select(F.when(~F.col("lone"), F.col("doc_id")).alias("_kept_id"), F.col("fp").alias("_kept_fp"),
                                                 (F.col("n") > 1).alias("_again")), "stays")
    removed(df.sparkSession, paths)
    equal = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_fp"))
    single = df.join(stays.where(~F.col("_again")), equal, "left_semi")
    # rows equal in id and text: only they are compared whole
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    one = df.join(stays.where("_again"), equal).groupBy("_kept_id", "_kept_fp") \
        .agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("_row")).select("_row.*")
    return single.unionByName(one)
