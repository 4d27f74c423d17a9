"""SCD2 merges: golden cases (FIXTURES.md 2.5, 2.6) and properties."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.operators import quality as Q
from tallyhawk.operators import scd2 as S

D1, D2, D3 = "2024-02-01", "2024-02-10", "2024-02-20"
INF_D = dt.date(9999, 12, 31)
INF_T = dt.datetime(9999, 12, 31)


def _d(s):
    return dt.date.fromisoformat(s)


def _t(s):
    return dt.datetime.fromisoformat(s)


def _snap(spark, rows):
    return spark.createDataFrame(rows, "id string, city string")


def _empty_terminals(spark):
    return S.empty_history(spark, {"id": "string"}, {"city": "string"}, grain="day")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


HCOLS = ["id", "city", "effective_from", "effective_to", "deleted_flg"]


def _merge3(spark, twice=False):
    h = _empty_terminals(spark)
    steps = [(D1, [("T1", "A"), ("T2", "B")]), (D2, [("T1", "C"), ("T3", "E")]), (D3, [("T1", "C"), ("T2", "B"), ("T3", "E")])]
    if twice:
        steps.append(steps[-1])
    for day, rows in steps:
        h = S.scd2_merge_snapshot(h, _snap(spark, rows), "id", ["city"], day, grain="day")
        h = h.cache()
    return h


def test_snapshot_merge_golden(spark):
    got = _rows(_merge3(spark), HCOLS)
    d2m1, d3m1 = _d(D2) - dt.timedelta(days=1), _d(D3) - dt.timedelta(days=1)
    assert got == sorted([
        ("T1", "A", _d(D1), d2m1, "N"),
        ("T1", "C", _d(D2), INF_D, "N"),
        ("T2", "B", _d(D1), d2m1, "N"),
        ("T2", "B", _d(D2), d3m1, "Y"),
        ("T2", "B", _d(D3), INF_D, "N"),
        ("T3", "E", _d(D2), INF_D, "N"),
    ])


def test_snapshot_merge_is_idempotent(spark):
    assert _rows(_merge3(spark, twice=True), HCOLS) == _rows(_merge3(spark), HCOLS)


def test_snapshot_history_properties(spark):
    h = _merge3(spark)
    open_per_key = h.filter(X.is_open("effective_to", "day")).groupBy("id").count()
    assert all(r["count"] == 1 for r in open_per_key.collect())
    assert Q.validity_violations(h, "id", grain="day").count() == 0
    # closing incrementally == recomputing every interval with lead()
    assert _rows(S.scd2_close(h, "id", grain="day"), HCOLS) == _rows(h, HCOLS)


def test_snapshot_extras_and_actions(spark):
    h = _empty_terminals(spark).withColumn("file_date", F.lit(None).cast("date"))
    h = S.scd2_merge_snapshot(h, _snap(spark, [("T1", "A")]), "id", ["city"], D1, extras={"file_date": X.date_lit(D1)})
    h2 = S.scd2_merge_snapshot(h, _snap(spark, [("T1", "B"), ("T2", "Z")]), "id", ["city"], D2,
                               extras={"file_date": X.date_lit(D2)}, with_action=True)
    got = _rows(h2, ["id", "city", "file_date", "change_action"])
    assert got == sorted([("T1", "A", _d(D1), "UPDATE"), ("T1", "B", _d(D2), "UPDATE"), ("T2", "Z", _d(D2), "INSERT")])


# ------------------------------------------------------------------ incremental (1 ms grain)

R1, R2, R3 = "2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00"
C1, C2 = "2023-12-01 10:00:00", "2023-12-02 11:00:00"
U1, U2 = "2024-01-01 12:00:00", "2024-01-02 12:00:00"


def _src(spark, rows):
    df = spark.createDataFrame(rows, "id string, v string, create_dt string, update_dt string")
    return df.withColumn("create_dt", F.col("create_dt").cast("timestamp_ntz")).withColumn(
        "update_dt", F.col("update_dt").cast("timestamp_ntz")
    )


def _keys(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def _empty_inc(spark):
    return S.empty_history(spark, {"id": "string"}, {"v": "string"}, grain="ms", extras={"processed_dt": "timestamp_ntz"})


ICOLS = ["id", "v", "effective_from", "effective_to", "deleted_flg"]


def _inc(spark, h, rows, live, run):
    out = S.scd2_merge_incremental(h, _src(spark, rows), _keys(spark, live), "id", ["v"], run)
    return out.cache()


def test_incremental_golden(spark):
    ms = dt.timedelta(milliseconds=1)
    h = _inc(spark, _empty_inc(spark), [("K1", "x", C1, None), ("K2", "y", C2, None)], ["K1", "K2"], R1)
    assert _rows(h, ICOLS) == sorted([("K1", "x", _t(C1), INF_T, "N"), ("K2", "y", _t(C2), INF_T, "N")])
    h = _inc(spark, h, [("K1", "z", C1, U1)], ["K1"], R2)
    assert _rows(h, ICOLS) == sorted([
        ("K1", "x", _t(C1), _t(U1) - ms, "N"), ("K1", "z", _t(U1), INF_T, "N"),
        ("K2", "y", _t(C2), _t(R2) - ms, "N"), ("K2", "y", _t(R2), INF_T, "Y"),
    ])
    h = _inc(spark, h, [("K2", "y", C2, U2)], ["K1", "K2"], R3)
    assert _rows(h, ICOLS) == sorted([
        ("K1", "x", _t(C1), _t(U1) - ms, "N"), ("K1", "z", _t(U1), INF_T, "N"),
        ("K2", "y", _t(C2), _t(R2) - ms, "N"), ("K2", "y", _t(R2), _t(U2) - ms, "Y"),
        ("K2", "y", _t(U2), INF_T, "N"),
    ])
    processed = {(r["id"], r["effective_from"]): r["processed_dt"] for r in h.collect()}
    assert processed[("K2", _t(U2))] == _t(R3) and processed[("K1", _t(C1))] == _t(R1)
    assert Q.validity_violations(h, "id").count() == 0
    assert _rows(S.scd2_close(h, "id"), ICOLS) == _rows(h, ICOLS)


def test_incremental_null_safe_changes(spark):
    h = _inc(spark, _empty_inc(spark), [("A", None, C1, None), ("B", "v", C1, None), ("C", None, C1, None), ("D", "same", C1, None)],
             ["A", "B", "C", "D"], R1)
    h = _inc(spark, h, [("A", "v", C1, U1), ("B", None, C1, U1), ("C", None, C1, U1), ("D", "same", C1, U1)], ["A", "B", "C", "D"], R2)
    counts = {r["id"]: r["count"] for r in h.groupBy("id").count().collect()}
    assert counts == {"A": 2, "B": 2, "C": 1, "D": 1}


def test_incremental_start_falls_back_to_create(spark):
    h = _inc(spark, _empty_inc(spark), [("A", "x", C1, None)], ["A"], R1)
    h = _inc(spark, h, [("A", "y", U1, None)], ["A"], R2)
    assert ("A", "y", _t(U1), INF_T, "N") in _rows(h, ICOLS)


def test_incremental_restore_never_starts_before_marker(spark):
    ms = dt.timedelta(milliseconds=1)
    h = _inc(spark, _empty_inc(spark), [("A", "x", C1, None)], ["A"], R1)
    h = _inc(spark, h, [], [], R2)  # A deleted at R2
    h = _inc(spark, h, [("A", "x", C1, U1)], ["A"], R3)  # U1 < R2
    got = _rows(h, ICOLS)
    assert ("A", "x", _t(R2), _t(R2), "Y") in got
    assert ("A", "x", _t(R2) + ms, INF_T, "N") in got
    assert Q.validity_violations(h, "id").count() == 0


def test_incremental_vanished_key_only_gets_marker(spark):
    h = _inc(spark, _empty_inc(spark), [("A", "x", C1, None)], ["A"], R1)
    h = _inc(spark, h, [("A", "changed", C1, U1), ("NEW", "n", C1, U1)], [], R2)
    got = _rows(h, ICOLS)
    assert [r for r in got if r[0] == "NEW"] == []
    assert sorted(r[1:] for r in got if r[0] == "A") == sorted([
        ("x", _t(C1), _t(R2) - dt.timedelta(milliseconds=1), "N"), ("x", _t(R2), INF_T, "Y"),
    ])


def test_rereading_unchanged_rows_is_idempotent(spark):
    rows = [("A", "x", C1, None), ("B", "y", C2, U1)]
    h = _inc(spark, _empty_inc(spark), rows, ["A", "B"], R1)
    h2 = _inc(spark, h, rows, ["A", "B"], R2)
    assert _rows(h2, ICOLS) == _rows(h, ICOLS)


def test_merge_leaves_closed_versions_untouched(spark):
    h = _inc(spark, _empty_inc(spark), [("A", "x", C1, None)], ["A"], R1)
    h = _inc(spark, h, [("A", "y", C1, U1)], ["A"], R2)
    closed_before = _rows(h.filter(F.col("effective_to") != X.inf_ts()), ICOLS)
    h3 = _inc(spark, h, [("A", "z", C1, U2)], ["A"], R3)
    assert set(closed_before) <= set(_rows(h3, ICOLS))


def test_classify_changes(spark):
    old = spark.createDataFrame([("A", "1"), ("B", None), ("C", "3")], "id string, v string")
    new = spark.createDataFrame([("A", "1"), ("B", "2"), ("D", "4")], "id string, v string")
    got = _rows(S.classify_changes(old, new, "id", ["v"]), ["id", "change_action"])
    assert got == [("A", "KEEP"), ("B", "UPDATE"), ("C", "DELETE"), ("D", "INSERT")]


def test_as_of_and_current(spark):
    h = _merge3(spark)
    at = S.scd2_as_of(h, X.date_lit("2024-02-15"), grain="day")
    assert _rows(at, ["id", "city"]) == [("T1", "C"), ("T3", "E")]
    assert _rows(S.scd2_current(h, grain="day"), ["id", "city"]) == [("T1", "C"), ("T2", "B"), ("T3", "E")]


def test_repeated_keys_in_change_set_and_snapshot(spark):
    # a change log with several changes of one key: the latest wins
    h = _inc(spark, _empty_inc(spark), [("A", "x", C1, None)], ["A"], R1)
    log = [("A", "y", C1, "2024-01-01 08:00:00"), ("A", "z", C1, U1), ("A", "w", C1, "2024-01-01 09:00:00")]
    h = _inc(spark, h, log, ["A", "A"], R2)
    assert ("A", "z", _t(U1), INF_T, "N") in _rows(h, ICOLS) and h.count() == 2
    # a snapshot listing a key twice keeps one deterministic version
    snap = _snap(spark, [("T1", "A"), ("T1", "B"), ("T2", "C")])
    h2 = S.scd2_merge_snapshot(_empty_terminals(spark), snap, "id", ["city"], D1, grain="day")
    assert _rows(h2, ["id", "city"]) == [("T1", "B"), ("T2", "C")]
