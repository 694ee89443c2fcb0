"""File sources, event flattening."""
import pytest
from pyspark.sql import functions as F

from martlake.sources import events as EV
from martlake.sources import files as FS

def _csv(tmp_dir, lines, name="a.csv"):
    import os
    os.makedirs(tmp_dir, exist_ok=True)
    with open(os.path.join(tmp_dir, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_scan_null_tokens_and_lineage(spark, tmp_dir):
    _csv(tmp_dir, ["id,name", "1,NA", "2, NA", "3,-", "4,", "5,null", "6,n/a", "7,ok"])
    df = FS.csv_scan(spark, tmp_dir, ["id", "name"], run_ts="2024-01-01 00:00:00")
    got = {r["id"]: r["name"] for r in df.collect()}
    assert got == {"1": None, "2": " NA", "3": "-", "4": None, "5": None, "6": None, "7": "ok"}
    row = df.first()
    assert row["_source_file"] == "a.csv" and row["_chunk_start"] == 0


def test_csv_scan_missing_column_raises(spark, tmp_dir):
    _csv(tmp_dir, ["id", "1"])
    with pytest.raises(ValueError, match="name"):
        FS.csv_scan(spark, tmp_dir, ["id", "name"])


def test_header_drift_per_file(spark, tmp_dir):
    _csv(tmp_dir, ["id,name", "1,a"], "a.csv")
    _csv(tmp_dir, ["name,extra", "b,c"], "b.csv")
    drift = {r["file_path"].rsplit("/", 1)[-1]: r for r in
             FS.header_drift(FS.file_headers(spark, tmp_dir), ["id", "name"]).collect()}
    assert drift["a.csv"]["missing"] == [] and drift["a.csv"]["extra"] == []
    assert drift["b.csv"]["missing"] == ["id"] and drift["b.csv"]["extra"] == ["extra"]


HEADERS = {"id,name": ("id", "name"), '"a, b","c ""d""","e\nf"': ("a, b", 'c "d"', "e\nf"), "x,x,,x": ("x", "x.1", "_c2", "x.2"),
           "\ufeffid": ("id",), "": ()}


@pytest.mark.parametrize("text", HEADERS)
def test_headers_are_csv_records(spark, tmp_dir, monkeypatch, text):
    monkeypatch.setattr(FS, "FIRST_BLOCK", 2)  # the record goes on behind the first block
    _csv(tmp_dir, [text, "1,2"] if text else [], "a.csv")
    if not text:
        open(f"{tmp_dir}/a.csv", "w").close()
    (f,) = FS.csv_files(spark, tmp_dir)
    assert f.header == HEADERS[text]


def test_csv_scan_finds_columns_by_name(spark, tmp_dir):
    _csv(tmp_dir, ["id,name", "1,a", '2,"b, ""c""\nd"'], "a.csv")
    _csv(tmp_dir, ['"name",extra,id', "x,y,3", ",,4"], "b.csv")
    _csv(tmp_dir, ["name,id"], "c.csv")
    _csv(tmp_dir, ["no,csv"], "d.txt")
    df = FS.csv_scan(spark, tmp_dir, ["id", "name"])
    got = {r["id"]: (r["name"], r["extra"], r["_source_file"], r["_source_size"]) for r in df.collect()}
    size = {n: __import__("os").path.getsize(f"{tmp_dir}/{n}") for n in ("a.csv", "b.csv")}
    assert got == {"1": ("a", None, "a.csv", size["a.csv"]), "2": ('b, "c"\nd', None, "a.csv", size["a.csv"]),
                   "3": ("x", "y", "b.csv", size["b.csv"]), "4": (None, None, "b.csv", size["b.csv"])}
    rows = {r["file_name"]: r["rows"] for r in FS.directory_manifest(spark, tmp_dir).collect()}
    assert rows == {"a.csv": 2, "b.csv": 2, "c.csv": 0}
    _csv(tmp_dir, ["name", "q"], "z.csv")
    with pytest.raises(ValueError, match="z.csv.*id"):
        FS.csv_scan(spark, tmp_dir, ["id", "name"])


def test_csv_scan_of_nothing_has_the_expected_columns(spark, tmp_dir):
    _csv(tmp_dir, ["a"], "other.txt")
    df = FS.csv_scan(spark, tmp_dir, ["id"])
    assert df.count() == 0 and df.columns[0] == "id" and FS.directory_manifest(spark, tmp_dir).count() == 0
    assert FS.file_profile(spark, tmp_dir).count() == 0


def test_file_profile_joins_types_of_all_values(spark, tmp_dir):
    _csv(tmp_dir, ["n,d,t,s,e,m", "1,1,2024-01-01,1,,2024-01-01", "-2,2.5,2024-01-02 10:00:00,x,NA,7", "+3,1e3,2024-01-03T10:00,2,,"], "a.csv")
    _csv(tmp_dir, ["n,d", "99999999999999999999,NaN"], "b.csv")
    _csv(tmp_dir, ["n"], "c.csv")
    got = {(r["file_name"], r["column"]): (r["type"], r["rows"], r["nulls"]) for r in FS.file_profile(spark, tmp_dir).collect()}
    assert got == {("a.csv", "n"): ("bigint", 3, 0), ("a.csv", "d"): ("double", 3, 0), ("a.csv", "t"): ("timestamp", 3, 0),
                   ("a.csv", "s"): ("string", 3, 0), ("a.csv", "e"): ("null", 3, 3), ("a.csv", "m"): ("string", 3, 1),
                   ("b.csv", "n"): ("double", 1, 0), ("b.csv", "d"): ("null", 1, 1), ("c.csv", "n"): ("null", 0, 0)}


def test_incremental_scan_pushes_filter(spark, tmp_dir):
    import datetime as dt
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3)), (3, None)],
                          "id int, ts timestamp_ntz").write.parquet(tmp_dir)
    df = FS.incremental_scan(spark.read.parquet(tmp_dir), "ts", "2024-01-02 00:00:00")
    assert [r["id"] for r in df.collect()] == [2]
    assert "GreaterThan(ts" in df._jdf.queryExecution().executedPlan().toString()


def test_incremental_scan_text_column(spark):
    df = spark.createDataFrame([("a", "2024-01-01T10:00:00+02:00"), ("b", "2024-01-01T09:30:00Z")],
                               "id string, ts string")
    assert [r["id"] for r in FS.incremental_scan(df, "ts", "2024-01-01 09:00:00").collect()] == ["b"]


def test_event_flatten_nested(spark):
    df = spark.createDataFrame([(1, '{"order_id": "o1", "amount": 2.5, "meta": {"region": "EU"}}'),
                                (2, None)], "event_id int, payload string")
    flat = EV.flatten_events(df, {"payload": "struct<order_id:string,amount:double,meta:struct<region:string>>"})
    assert flat.columns == ["event_id", "payload_order_id", "payload_amount", "payload_meta_region"]
    assert flat.orderBy("event_id").first()["payload_meta_region"] == "EU"
    v = EV.variant_fields(df, "payload", {"amt": "$.amount::double"}).orderBy("event_id").first()
    assert v["amt"] == 2.5


def test_typed_csv_quarantines_malformed_lines(spark, tmp_dir):
    from martlake.operators import quarantine as Q
    _csv(tmp_dir, ["id,amount,ts", "1,2.5,2024-01-01 10:00:00", "2,abc,2024-01-01 11:00:00",
                   "3,4.0,not-a-time", "4,1.0"])
    df = FS.typed_csv_scan(spark, tmp_dir, "id int, amount double, ts timestamp_ntz")
    valid, bad = Q.split(df.cache(), Q.corrupt_record_rule())
    assert sorted(r["id"] for r in valid.collect()) == [1]
    assert sorted(r["_corrupt_record"].split(",")[0] for r in bad.collect()) == ["2", "3", "4"]
