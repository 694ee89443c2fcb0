"""What the near-duplicate stage holds on disk while it runs, and behind it."""

import glob
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martlake.llm import jaccard
from martlake.llm.components import components
from martlake.llm.text import CLEANUP, saved, scratch


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left(spark):
    return set(glob.glob(scratch(spark, "").rpartition("/")[0].removeprefix("file:") + "/*"))


def test_first_grams_of_a_single_class_go_however_many_there_are(spark):
    rng = np.random.default_rng(3)
    rows, each = 40, 50_000
    grams = rng.integers(-(1 << 63), 1 << 63, (rows, each))
    grams[1:9, 7] = grams[0, 5]  # one of nine classes, also across blocks
    grams[30, :3] = grams[31, 10:13]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * each), pa.array(grams.ravel()))
    short = pa.array([[11, 12], [12, 13], [14]], pa.list_(pa.int64()))
    cls = np.arange(rows + 3) * 7 - 40
    table = pa.table({"cls": pa.array(cls), "n": pa.array(np.full(rows + 3, 9)), "prefix": pa.chunked_array([lists, short])})
    got = jaccard.repeated_grams(spark.createDataFrame(table).repartition(3)).collect()
    want = {(cls[0], grams[0, 5])} | {(c, grams[0, 5]) for c in cls[1:9]} | {(c, g) for c in cls[30:32] for g in grams[30, :3]} \
        | {(cls[rows], 12), (cls[rows + 1], 12)}
    pairs = [(r.cls, r.gram) for r in got]
    assert len(pairs) == len(set(pairs)) and want <= set(pairs)
    assert len(pairs) - len(want) <= 100  # of two million; a bitmap of 2^27 slots let through about 15,000 of each million
    share = {r.cls: r.central for r in got}
    assert share[cls[rows]] == 0.5 and {r.n for r in got} == {9} and cls[rows + 2] not in share
    assert jaccard.repeated_grams(spark.createDataFrame(table).limit(0)).count() == 0


def test_a_saved_result_holds_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(CLEANUP)
    counts = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(100):  # executors delete them in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before and spark.conf.get(CLEANUP) == was
    assert sorted(r["count"] for r in counts.collect()) == [142] * 1 + [143] * 6


def test_near_duplicates_keep_only_what_is_still_read(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words[:50 + i % 3], *(f"x{i % 4}y{j}" for j in range(i % 5))])) for i in range(40)]
                                 + [(90, None), (91, "alone here")], "doc_id long, text string")
    before = left(spark)
    kept = jaccard.keep_one(docs, 5, 80)
    (stays,) = left(spark) - before
    assert "/stays-" in stays and {90, 91, 0} <= {r.doc_id for r in kept.collect()}
    before, last = left(spark), []
    result = components(spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a long, b long"), paths=last)
    assert {f"file:{x}" for x in left(spark) - before} == {"file:" + x.removeprefix("file:") for x in last} and len(last) == 1
    assert {tuple(r) for r in result.collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)}
