"""Streaming: restart from checkpoint reads nothing twice; duplicates vanish."""
import datetime as dt

from pyspark.sql import functions as F

from martlake.session import scratch_path
from martlake.streaming import admission as AD
from martlake.streaming import commits as CM
from martlake.streaming import events as ST

SCHEMA = "event_id bigint, ts timestamp_ntz, v double"


def test_restart_and_dedup(spark):
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("landing", "sink", "ckpt"))
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t, 1.0), (2, t, 2.0)], SCHEMA).write.mode("append").parquet(landing)
    stream = ST.dedup_within_watermark(ST.event_stream(spark, landing, SCHEMA, 1), "event_id", "ts", "1 day")
    ST.run_to_completion(stream, sink, ckpt)
    spark.createDataFrame([(2, t, 2.0), (3, t + dt.timedelta(hours=1), 3.0)], SCHEMA) \
        .write.mode("append").parquet(landing)
    stream = ST.dedup_within_watermark(ST.event_stream(spark, landing, SCHEMA, 1), "event_id", "ts", "1 day")
    info = ST.run_to_completion(stream, sink, ckpt)
    assert info["rows"] == 2                         # only the new file was read
    got = sorted(r["event_id"] for r in spark.read.parquet(sink).collect())
    assert got == [1, 2, 3]


T = dt.datetime(2024, 1, 1)


def _land(spark, landing, rows):
    spark.createDataFrame([(i, T + dt.timedelta(hours=h), float(v)) for i, h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def test_late_unique_events_are_kept_once_and_late_repeats_dropped(spark):
    landing, sink, late, ckpt = (scratch_path(spark, x) for x in ("landing", "sink", "late", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def restart():
        stream = ST.dedup_within_watermark(ST.event_stream(spark, landing, SCHEMA, 1), "event_id", "ts", "1 hour")
        ST.run_to_completion(stream.withColumn(ST.DAY, F.to_date("ts").cast("string")), sink, ckpt, partition_by=[ST.DAY])
        return ST.keep_late(spark, landing, sink, late, schema, "event_id", "ts")
    _land(spark, landing, [(1, 0, 1), (2, 1, 2)])
    _land(spark, landing, [(3, 100, 3)])
    assert restart() == 0
    _land(spark, landing, [(1, 0, 1), (9, 0, 9), (9, 0, 9), (4, 101, 4)])  # 1: repeat, 9: unique, both far behind
    assert restart() == 1
    assert restart() == 0  # every file was gone through
    _land(spark, landing, [(9, 0, 9)])
    assert restart() == 0
    got = sorted((r["event_id"], r["v"]) for r in ST.read_events(spark, sink, late, "event_id").collect())
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (9, 9.0)]


def test_batch_sink_holds_each_landed_row_once(spark):
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("landing", "sink", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def restart():
        ST.drain(CM.write_batches(ST.event_stream(spark, landing, SCHEMA, 1), sink, ckpt, ["event_id"]))
    _land(spark, landing, [(i, i, i) for i in range(20)])
    _land(spark, landing, [(i, i + 1, 100 + i) for i in range(5)])
    restart()
    restart()
    _land(spark, landing, [(3, 50, 7)])
    restart()
    batches = CM.committed(spark, sink)
    assert [b.rows for b in batches] == [20, 5, 1]
    assert CM.read_deliveries(spark, sink, schema).count() == 26
    state = {r["event_id"]: r["v"] for r in CM.read_latest(spark, sink, schema, ["event_id"], ["ts"]).collect()}
    assert state == {i: float(7 if i == 3 else 100 + i if i < 5 else i) for i in range(20)}


def test_a_batch_committed_before_a_crash_is_not_committed_again(tmp_path):
    import pyarrow as pa
    writer = CM.BatchWriter(str(tmp_path))
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3], CM.BUCKET: pa.array([0, 1, 0], pa.int32())})
    first, again, dead = (writer.write(iter([batch])) for _ in range(3))
    assert first.rows == 3 and len(first.files) == 2
    writer.commit([first], 7)
    writer.commit([again], 7)
    writer.abort([dead, None], 8)
    files = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet"))
    assert files == sorted(first.files) and [p.name for p in (tmp_path / CM.BATCHES).iterdir()] == [f"{7:020d}.json"]


def test_admission_cuts_batches_of_n_rows_or_after_the_wait(spark):
    landing, admitted = scratch_path(spark, "landing"), scratch_path(spark, "admitted")
    schema = spark.createDataFrame([], SCHEMA).schema

    def admit(now):
        return AD.admit(spark, landing, admitted, schema, rows=10, wait_s=60, now_ms=now)

    def sizes():
        return [r["count"] for r in spark.read.parquet(f"{admitted}/batches").groupBy("batch").count().orderBy("batch").collect()]
    assert admit(1 << 50) == 0
    _land(spark, landing, [(i, i, i) for i in range(25)])
    arrived = max(r.arrived_ms for r in AD.landed_files(spark, landing).collect())
    assert admit(arrived + 1000) == 2 and sizes() == [10, 10]
    assert admit(arrived + 2000) == 0
    _land(spark, landing, [(100 + i, i, i) for i in range(7)])
    assert admit(arrived + 3000) == 1 and sizes() == [10, 10, 10]
    assert admit(arrived + 10 ** 9) == 1 and sizes() == [10, 10, 10, 2]
    assert admit(arrived + 10 ** 9) == 0
    _land(spark, landing, [(200 + i, i, i) for i in range(12)])
    assert admit(arrived + 10 ** 9 * 2) == 2 and sizes() == [10, 10, 10, 2, 10, 2]
    sink = scratch_path(spark, "sink")
    done = ST.run_to_completion(AD.batch_stream(spark, admitted, schema), sink, scratch_path(spark, "ckpt"))
    assert sorted(done["sizes"]) == [2, 2, 10, 10, 10, 10]
    got = spark.read.parquet(sink)
    assert got.count() == 44 and got.select("event_id").distinct().count() == 44


def test_an_admission_that_died_is_repeated_without_doubling(spark, monkeypatch):
    landing, admitted = scratch_path(spark, "landing"), scratch_path(spark, "admitted")
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, [(i, i, i) for i in range(25)])
    with monkeypatch.context() as m:
        m.setattr(AD.SN, "note", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("dies before its note")))
        try:
            AD.admit(spark, landing, admitted, schema, 10, 60, 0)
        except RuntimeError:
            pass
    assert AD.admit(spark, landing, admitted, schema, 10, 0, 1 << 50) == 3
    got = spark.read.parquet(f"{admitted}/batches")
    assert got.count() == 25 and got.select("event_id").distinct().count() == 25


def test_small_batches_are_cut_by_few_tasks(spark):
    landing, admitted = scratch_path(spark, "landing"), scratch_path(spark, "admitted")
    _land(spark, landing, [(i, i, i) for i in range(60)])
    assert AD.admit(spark, landing, admitted, spark.createDataFrame([], SCHEMA).schema, 1, 0, 1 << 50) == 60
    files = [r[0] for r in spark.read.parquet(f"{admitted}/batches").select("_metadata.file_name").collect()]
    assert len(set(files)) <= len(files) == 60
    assert {int(f.split("-")[1]) for f in files} <= set(range(spark.sparkContext.defaultParallelism))


def test_a_trigger_takes_many_batches_whole(spark):
    landing, admitted, sink = (scratch_path(spark, x) for x in ("landing", "admitted", "sink"))
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, landing, [(i, i, i) for i in range(47)])
    assert AD.admit(spark, landing, admitted, schema, 10, 0, 1 << 50) == 5
    done = ST.run_to_completion(AD.batch_stream(spark, admitted, schema, 3), sink, scratch_path(spark, "ckpt"))
    assert done["batches"] == 2 and done["rows"] == 47 and max(done["sizes"]) <= 30
    assert AD.check_batches(spark.read.parquet(sink), 10) == 5
    assert sorted(r["event_id"] for r in ST.read_sink(spark, sink, "event_id", ["ts"], drop=["batch"]).collect()) == list(range(47))


def test_check_batches_sees_every_batch(spark):
    def check(*sizes):
        rows = [(b,) for b, n in enumerate(sizes) for _ in range(n)]
        return AD.check_batches(spark.createDataFrame(rows, "batch bigint"), 3)
    assert check() == 0 and check(2) == 1 and check(3, 3) == 2 and check(3, 3, 1) == 3
    for wrong in ((2, 3), (3, 4), (3, 0, 3), (0, 3), (4,), (3, 2, 3, 3)):
        try:
            check(*wrong)
        except RuntimeError:
            continue
        raise AssertionError(wrong)
