"""Property tests: loads against a plain Python model on random small batches."""
import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlake.operators import merge as MG
from martlake.operators import scd2 as S
from martlake.operators.fingerprint import fingerprint

SCHEMA = "id int, amount double, ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)

rows = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 1000), st.integers(0, 5)), max_size=12)


def _frame(spark, data):
    return spark.createDataFrame([(k, float(a), T0 + dt.timedelta(hours=h)) for k, a, h in data], SCHEMA)


def _latest(data):
    model = {}
    for k, a, h in data:
        cand = (T0 + dt.timedelta(hours=h), float(a))
        # greatest (ts, row) wins, as latest_by_key orders by (ts, row)
        if k not in model or (cand[0], (cand[1], cand[0])) > (model[k][0], (model[k][1], model[k][0])):
            model[k] = cand
    return model


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, batch=rows)
def test_upsert_matches_dict_model(spark, target, batch):
    t = {k: v for k, v in _latest(target).items()}
    want = dict(t)
    want.update(_latest(batch))
    tdf = MG.upsert(_frame(spark, []), _frame(spark, target), ["id"], ["ts"])  # keyed target
    got = MG.upsert(tdf, _frame(spark, batch), ["id"], ["ts"])
    assert {r["id"]: (r["ts"], r["amount"]) for r in got.collect()} == want
    assert got.count() == len(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, batch=rows)
def test_insert_ignore_is_idempotent(spark, target, batch):
    tdf = MG.upsert(_frame(spark, []), _frame(spark, target), ["id"], ["ts"])
    once = MG.insert_ignore(tdf, _frame(spark, batch), ["id"], ["ts"])
    twice = MG.insert_ignore(once, _frame(spark, batch), ["id"], ["ts"])
    assert fingerprint(once, "x").first() == fingerprint(twice, "x").first()


def test_scd2_with_change_detection_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, seg string")
    h0 = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, seg string")
    h1 = S.apply_scd2(h0, batch, ["k"], "2024-01-02 00:00:00", detect_changes=["seg"])
    h2 = S.apply_scd2(h1, batch, ["k"], "2024-01-03 00:00:00", detect_changes=["seg"])
    assert fingerprint(h1, "x").first() == fingerprint(h2, "x").first()


def test_diff_matches_except_all(spark):
    from martlake.operators.fingerprint import diff
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (4, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (5, "e"), (5, "e")], "k int, v string")
    got = sorted(tuple(r) for r in diff(left, right).collect())
    copies = Counter([(*r, "left_only") for r in left.exceptAll(right).collect()]
                     + [(*r, "right_only") for r in right.exceptAll(left).collect()])
    assert got == sorted((*r, n) for r, n in copies.items())


cells = st.one_of(st.none(), st.integers(0, 2))
tables = st.lists(st.tuples(cells, cells, st.sampled_from([None, "", "a"])), max_size=10)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=tables, right=tables)
def test_digests_and_diff_tell_any_two_tables_apart(spark, left, right):
    from martlake.operators.fingerprint import diff, digest_tree
    a, b = (spark.createDataFrame(x, "x int, y int, s string") for x in (left, right))
    assert (fingerprint(a, "t").first() == fingerprint(b, "t").first()) == (Counter(left) == Counter(right))
    got = {(*r[:3], r["side"]): r["copies"] for r in diff(a, b, ["x"]).collect()}
    want = {(*k, "left_only"): n for k, n in (Counter(left) - Counter(right)).items()}
    want |= {(*k, "right_only"): n for k, n in (Counter(right) - Counter(left)).items()}
    assert got == want
    levels = {}
    for r in digest_tree(a).collect():
        levels.setdefault(r["level"], []).append((r["rows"], r["low"], r["high"]))
    sums = {tuple(map(sum, zip(*v, strict=True))) for v in levels.values()}
    assert len(sums) <= 1 and (not left or (len(levels[0]) == 1 and levels[0][0][0] == len(left)))


loads = st.lists(st.tuples(st.integers(1, 4), st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2)), max_size=4,
                                                       unique_by=lambda r: r[0])), min_size=1, max_size=4, unique_by=lambda x: x[0])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=loads, order=st.randoms(use_true_random=False))
def test_scd2_loads_in_any_order_and_twice_give_one_history(spark, loads, order):
    base = spark.createDataFrame([(0, 9), (1, 9)], "k int, v int")

    def history(batches):
        h = S.initial_history(base, ["k"], "2024-01-01 00:00:00")
        for day, rows in batches:
            h = S.apply_scd2(h, spark.createDataFrame(rows, "k int, v int"), ["k"], f"2024-02-0{day} 00:00:00")
        return h
    want = history(sorted(loads))
    again = list(loads) * 2
    order.shuffle(again)
    assert fingerprint(want, "h").first() == fingerprint(history(again).select(*want.columns), "h").first()
    model = {(k, "2024-01-01"): 9 for k in (0, 1)} | {(k, f"2024-02-0{d}"): v for d, rows in loads for k, v in rows}
    got = {(r["k"], str(r["_scd_valid_from"].date())): r["v"] for r in want.collect()}
    assert got == model and want.select("_surrogate_key").distinct().count() == len(model)
    assert want.where("_scd_is_current").count() == len({k for k, _ in model})
