"""Load strategies: upsert, partial upsert, insert-ignore, SCD2, marks, replay properties."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlake.operators import control as CT
from martlake.operators import fingerprint as FP
from martlake.operators import merge as MG
from martlake.operators import scd2 as S
from martlake.sinks import clustered as CL
from martlake.sinks import lake as L
from martlake.sinks import snapshots as SN

SCHEMA = "id int, amount double, ts timestamp_ntz"
T = dt.datetime(2024, 1, 1)


def fp(df):
    return FP.fingerprint(df, "x").first()["fingerprint"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_latest_wins_and_idempotent(spark):
    target = spark.createDataFrame([(1, 10.0, T), (2, 20.0, T)], SCHEMA)
    batch = spark.createDataFrame([(2, 21.0, T + dt.timedelta(hours=1)), (2, 22.0, T + dt.timedelta(hours=2)),
                                   (3, 30.0, T)], SCHEMA)
    once = MG.upsert(target, batch, ["id"], order_by=["ts"])
    assert rows(once.select("id", "amount")) == [(1, 10.0), (2, 22.0), (3, 30.0)]
    twice = MG.upsert(once, batch, ["id"], order_by=["ts"])
    assert fp(once) == fp(twice)
    shuffled = MG.upsert(target, batch.orderBy(F.rand(7)).repartition(3), ["id"], order_by=["ts"])
    assert fp(once) == fp(shuffled)


def test_upsert_empty_batch(spark):
    target = spark.createDataFrame([(1, 10.0, T)], SCHEMA)
    assert rows(MG.upsert(target, spark.createDataFrame([], SCHEMA), ["id"], ["ts"])) == rows(target)


def test_upsert_partial_keeps_other_columns(spark):
    target = spark.createDataFrame([(1, 10.0, T), (2, 20.0, T)], SCHEMA)
    batch = spark.createDataFrame([(2, 99.0), (3, 5.0)], "id int, amount double")
    got = rows(MG.upsert_partial(target, batch, ["id"]))
    assert got == [(1, 10.0, T), (2, 99.0, T), (3, 5.0, None)]


def test_insert_ignore_keeps_existing(spark):
    target = spark.createDataFrame([(1, 10.0, T)], SCHEMA)
    batch = spark.createDataFrame([(1, 99.0, T), (2, 20.0, T)], SCHEMA)
    assert rows(MG.insert_ignore(target, batch, ["id"], ["ts"]).select("id", "amount")) == [(1, 10.0), (2, 20.0)]


def test_apply_defaults_keeps_explicit_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, status string")
    out = MG.apply_defaults(df, {"status": "pending", "currency": "USD", "quantity": 1}, {"quantity": "int"})
    assert out.first().asDict() == {"id": 1, "status": None, "currency": "USD", "quantity": 1}


def test_scd2_expire_append_and_as_of(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, seg string")
    h0 = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
    batch = spark.createDataFrame([(2, "B")], "k int, seg string")
    h1 = S.apply_scd2(h0, batch, ["k"], "2024-01-02 00:00:00")
    cur = {r["k"]: r["seg"] for r in h1.filter("_scd_is_current").collect()}
    assert cur == {1: "a", 2: "B"} and h1.count() == 3
    old = {r["k"]: r["seg"] for r in S.as_of_view(h1, "2024-01-01 12:00:00").collect()}
    assert old == {1: "a", 2: "b"}
    # surrogate keys are deterministic
    assert fp(h1.select("_surrogate_key")) == fp(S.apply_scd2(h0, batch, ["k"], "2024-01-02 00:00:00")
                                                  .select("_surrogate_key"))


def test_scd2_detect_changes_skips_unchanged(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, seg string")
    h0 = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
    batch = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "k int, seg string")
    h1 = S.apply_scd2(h0, batch, ["k"], "2024-01-02 00:00:00", detect_changes=["seg"])
    assert h1.count() == 4  # 1 unchanged, 2 expired + new, 3 new
    assert h1.filter("_scd_is_current").count() == 3


def test_watermarks_save_and_lookup(spark):
    marks = CT.empty_marks(spark)
    a = spark.createDataFrame([("p", "t", "2024-01-01 00:00:00", T)], CT.MARK_SCHEMA)
    b = spark.createDataFrame([("p", "t", "2024-01-02 00:00:00", T + dt.timedelta(days=1))], CT.MARK_SCHEMA)
    m = CT.save_marks(CT.save_marks(marks, a), b)
    assert CT.mark_value(m, "p", "t") == "2024-01-02 00:00:00"
    assert CT.mark_value(m, "p", "other") is None


def test_merge_partitions_rewrites_touched_only(spark, tmp_dir):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "b/c")], "id int, v double, p string")
    first = SN.publish(df, tmp_dir, ["p"])
    batch = spark.createDataFrame([(2, 20.0, "a"), (4, 4.0, "a")], "id int, v double, p string")
    L.merge_partitions(spark, tmp_dir, batch, ["id"], ["p"])
    after = SN.current(spark, tmp_dir)
    assert rows(SN.read(spark, tmp_dir)) == [(1, 1.0, "a"), (2, 20.0, "a"), (3, 3.0, "b/c"), (4, 4.0, "a")]
    assert set(first.leaves) & set(after.leaves) == {x for x in first.leaves if SN.leaf_values(x) == ("b/c",)}
    assert rows(SN.read(spark, tmp_dir, first.version)) == rows(df)  # the version before can still be read


def test_merge_keeps_rows_of_a_null_partition(spark, tmp_dir):
    df = spark.createDataFrame([(5, 1.0, None), (6, 2.0, "a")], "id int, v double, p string")
    SN.publish(df, tmp_dir, ["p"])
    batch = spark.createDataFrame([(7, 3.0, None)], "id int, v double, p string")
    L.merge_partitions(spark, tmp_dir, batch, ["id"], ["p"])
    assert sorted(r.id for r in SN.read(spark, tmp_dir).collect()) == [5, 6, 7]


@pytest.mark.parametrize("kind", ["int", "string", "timestamp_ntz"])
def test_clustered_upsert_rewrites_only_leaves_that_hold_a_key(spark, tmp_dir, kind):
    def typed(ids, v):
        k = {"int": F.col("id").cast("int"), "string": F.format_string("k%04d", F.col("id")),
             "timestamp_ntz": F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))}[kind]
        df = spark.createDataFrame([(i,) for i in ids], "id bigint")
        return df.select(k.alias("k"), F.lit(v).alias("v"), F.col("id"))
    even = list(range(0, 400, 2))
    first = CL.publish_clustered(typed([*even, None], "old"), tmp_dir, "k", rows_per_leaf=20)
    assert len(first.leaves) >= 8
    changes = [4, 6, 7, 391, 1000]  # two present keys in one leaf, three new ones
    after = CL.upsert_clustered(typed(changes, "new"), tmp_dir)
    assert len(set(first.leaves) - set(after.leaves)) == 1
    got = {r["id"]: r["v"] for r in CL.read_clustered(spark, tmp_dir).collect()}
    assert got == {i: "new" if i in changes else "old" for i in [*even, None, *changes]}
    last = CL.upsert_clustered(typed([None, 1000], "newer"), tmp_dir)
    assert len(set(after.leaves) - set(last.leaves)) <= 2
    got = {r["id"]: r["v"] for r in CL.read_clustered(spark, tmp_dir).collect()}
    assert got[None] == got[1000] == "newer" and got[4] == "new" and len(got) == len(even) + 4
    assert CL.read_clustered(spark, tmp_dir).count() == len(got)


def test_a_load_that_dies_before_its_commit_is_not_seen(spark, tmp_dir):
    old = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "new")], "id int, v string")
    SN.publish(old, tmp_dir, notes={"mark": "1"})
    pending = SN.prepare(new, tmp_dir, notes={"mark": "2"})
    assert rows(SN.read(spark, tmp_dir)) == [(1, "old")] and SN.current(spark, tmp_dir).notes == {"mark": "1"}
    # dies inside of the commit file: not a version, and the next one isn't held up
    SN.create_only(spark, f"{tmp_dir}/_commits/{2:020d}.json", '{"leaves": [')
    assert SN.current(spark, tmp_dir).version == 1
    assert SN.commit(spark, pending).version == 3
    assert rows(SN.read(spark, tmp_dir)) == [(1, "new"), (2, "new")] and SN.current(spark, tmp_dir).notes == {"mark": "2"}


def test_of_two_writers_from_one_version_one_commits(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "id int")
    SN.publish(df, tmp_dir)
    a, b = SN.prepare(df, tmp_dir, mode="append"), SN.prepare(df, tmp_dir, mode="append")
    SN.commit(spark, a)
    with pytest.raises(SN.CommitConflict):
        SN.commit(spark, b)
    assert SN.read(spark, tmp_dir).count() == 2
    assert SN.expire(spark, tmp_dir) == []  # young folders may belong to a running load
    import time
    gone = SN.expire(spark, tmp_dir, keep=1, now_s=time.time() + 10 ** 6)
    assert gone == ["/".join(b.snapshot.leaves[-1].split("/")[:2])] and SN.read(spark, tmp_dir).count() == 2


def test_a_view_follows_the_version_and_never_replaces_a_table(spark, tmp_dir):
    for days in ((1, 2, 3), (2,), ()):
        df = spark.createDataFrame([(d, dt.date(2024, 1, d)) for d in days], "id int, d date")
        SN.publish(df, tmp_dir, ["d"])
        SN.register_view(spark, "replaced_whole", tmp_dir)
        assert sorted((r.id, r.d.day) for r in spark.table("replaced_whole").collect()) == [(d, d) for d in days]
    spark.sql("DROP VIEW replaced_whole")
    spark.range(3).write.mode("overwrite").saveAsTable("kept_managed")
    with pytest.raises(ValueError):
        SN.register_view(spark, "kept_managed", tmp_dir)
    assert spark.table("kept_managed").count() == 3
    spark.sql("DROP TABLE kept_managed")


def test_full_refresh_may_read_what_it_replaces(spark, tmp_dir):
    L.full_refresh(spark.range(5), tmp_dir)
    assert L.full_refresh(SN.read(spark, tmp_dir).where("id > 2"), tmp_dir) == 2
    assert sorted(r.id for r in SN.read(spark, tmp_dir).collect()) == [3, 4]


def test_repeated_keys_without_an_order_fail_and_null_keys_replace(spark):
    target = spark.createDataFrame([(1, 10.0, T), (None, 5.0, T)], SCHEMA)
    twice = spark.createDataFrame([(2, 1.0, T), (2, 2.0, T)], SCHEMA)
    for load in (MG.upsert, MG.upsert_partial):
        with pytest.raises(Exception, match="key repeated"):
            load(target, twice, ["id"]).collect()
    batch = spark.createDataFrame([(None, 6.0, T)], SCHEMA)
    once = MG.upsert(target, batch, ["id"])
    assert fp(once) == fp(MG.upsert(once, batch, ["id"])) and once.count() == 2
    assert MG.upsert_partial(target, batch, ["id"]).where("id is null").first()["amount"] == 6.0
    assert MG.rows_to_insert(target, batch, ["id"]).count() == 0


def test_latest_by_key_takes_maps(spark):
    from martlake.operators.dedup import latest_by_key
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"a": 2}), (2, 1, None)], "k int, t int, m map<string,int>")
    assert {r.k: r.m for r in latest_by_key(df, ["k"], ["t"]).collect()} == {1: {"a": 2}, 2: None}


def test_surrogate_keys_tell_nulls_and_colons_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a:b", "c"), ("a", "b:c"), ("\\N", "a")], "x string, y string")
    keys = S.initial_history(df, ["x", "y"], "2024-01-01 00:00:00").select("_surrogate_key").distinct()
    assert keys.count() == 5


def test_incremental_batch_replay_overwrites_itself(spark, tmp_dir):
    df = spark.createDataFrame([(1, 1.0, T), (2, 2.0, T + dt.timedelta(seconds=5))], SCHEMA)
    b1 = L.write_incremental(df, tmp_dir, "ts", "orders")
    b2 = L.write_incremental(df, tmp_dir, "ts", "orders")
    assert b1 == b2 == "orders_20240101_000000_20240101_000005"
    assert spark.read.parquet(tmp_dir).count() == 2


def test_batches_of_two_windows_do_not_replace_each_other(spark, tmp_dir):
    for window, ids in ((("2024-01-01 00:00:00", "2024-01-02 00:00:00"), (1, 2)), (("2023-12-31 00:00:00", "2024-01-02 00:00:00"), (3,)),
                        (("2024-01-01 00:00:00", "2024-01-02 00:00:00"), (1, 2, 4))):
        batch = spark.createDataFrame([(i, 1.0, T) for i in ids], SCHEMA)  # all with the same mark
        bid = L.write_incremental(batch, tmp_dir, "ts", "orders", window)
    assert bid == "orders_20240101_000000_20240102_000000"
    assert sorted(r.id for r in spark.read.parquet(tmp_dir).collect()) == [1, 2, 3, 4]


def test_incremental_batch_needs_mark_values(spark, tmp_dir):
    import pytest
    df = spark.createDataFrame([(1, 1.0, None)], SCHEMA)
    with pytest.raises(ValueError, match="non-idempotent"):
        L.write_incremental(df, tmp_dir, "ts", "orders")


def test_lake_write_manifest(spark, tmp_dir):
    df = spark.createDataFrame([(1, 1.0, T), (2, 2.0, T + dt.timedelta(days=1))], SCHEMA)
    L.write_partitioned(df, tmp_dir, "ts", metadata={"source": "api", "ingestion_time": "2024-01-03 00:00:00"})
    m = L.read_manifest(spark, tmp_dir).first()
    assert (m["source"], m["row_count"]) == ("api", "2")
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 2 and sorted(r["day"] for r in back.select("day").collect()) == [1, 2]


def test_scd2_bucketed_rewrites_touched_buckets_only(spark, tmp_dir):
    base = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("seg"))
    h0 = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
    L.write_scd2_history(h0, tmp_dir, ["k"], buckets=8)
    before = SN.current(spark, tmp_dir)
    batch = spark.createDataFrame([(3, "B"), (500, "new")], "k int, seg string")
    touched = {(str(r[0]),) for r in batch.select(L.key_bucket(["k"], 8)).collect()}
    L.apply_scd2_partitions(spark, tmp_dir, batch, ["k"], "2024-01-02 00:00:00", buckets=8)
    h = SN.read(spark, tmp_dir).drop(L.BUCKET)
    want = S.apply_scd2(h0, batch, ["k"], "2024-01-02 00:00:00")
    assert fp(h.select(*want.columns)) == fp(want)
    kept = set(before.leaves) & set(SN.current(spark, tmp_dir).leaves)
    assert kept == {x for x in before.leaves if SN.leaf_values(x) not in touched}


def test_scd2_of_null_keys_and_repeated_keys(spark):
    base = spark.createDataFrame([(None, "a"), (2, "b")], "k int, seg string")
    h = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
    batch = spark.createDataFrame([(None, "A"), (2, "x"), (2, "y")], "k int, seg string")
    h = S.apply_scd2(h, batch, ["k"], "2024-01-02 00:00:00")
    assert h.count() == 4 and h.where("_scd_is_current").count() == 2 and h.select("_surrogate_key").distinct().count() == 4
    assert fp(S.apply_scd2(h, batch, ["k"], "2024-01-02 00:00:00").select(*h.columns)) == fp(h)


def test_scd2_change_detection_compares_with_the_version_before(spark):
    h = S.initial_history(spark.createDataFrame([(1, "a", 1)], "k int, seg string, n int"), ["k"], "2024-01-01 00:00:00")
    for day, seg, n in ((2, "a", 2), (3, "b", 3), (4, None, 4), (5, None, 5)):
        h = S.apply_scd2(h, spark.createDataFrame([(1, seg, n)], "k int, seg string, n int"), ["k"], f"2024-01-0{day} 00:00:00", ["seg"])
    assert [(r.seg, r.n) for r in h.orderBy("_scd_valid_from").collect()] == [("a", 1), ("b", 3), (None, 4)]
