"""Inputs that arrive late, without rows or corrected: the warehouse gives the
state and report that the chronological order gives."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyhawk.operators import affected as AF
from tallyhawk.operators import rules as R
from tallyhawk.operators import scd2 as S
from tallyhawk.plans import warehouse as P
from tests import builders as B

RUN = "2024-03-09 00:00:00"
INF = "9999-12-31"


def people(spark, wh, rows, run_ts="2024-01-02 00:00:00", changes=None):
    """rows: (id, passport, passport end, contract end): card, account and client of one id."""
    ts = "timestamp_ntz'2024-01-01 00:00:00'" if changes is None else f"timestamp_ntz'{changes}'"
    frame = spark.createDataFrame(rows, "id string, passport string, pv string, cv string")
    stamped = frame.select("*", F.expr(ts).alias("create_dt"), F.expr("cast(null as timestamp_ntz)").alias("update_dt"))
    clients = stamped.selectExpr("id client_id", "'L' last_name", "'F' first_name", "'P' patronymic", "date'1980-01-01' date_of_birth",
                                 "passport passport_num", "date(pv) passport_valid_to", "'+1' phone", "create_dt", "update_dt")
    accounts = stamped.selectExpr("id account", "date(cv) valid_to", "id client", "create_dt", "update_dt")
    cards = stamped.selectExpr("id card_num", "id account", "create_dt", "update_dt")
    live = spark.createDataFrame([(i,) for i in ("C1", "C2", "C3")], "id string")
    errors = P.load_dimensions(wh, {"cards": (cards, live), "accounts": (accounts, live), "clients": (clients, live)}, run_ts)
    assert errors == {}


ALL = [("C1", "P1", "2030-01-01", "2030-01-01"), ("C2", "P2", "2030-01-01", "2030-01-01"), ("C3", "P3", "2030-01-01", "2030-01-01")]


def terms(spark, *rows):
    return spark.createDataFrame([(t, "ATM", c, "a") for t, c in rows], "terminal_id string, terminal_type string, terminal_city string, terminal_address string")


def listing(spark, *rows):
    return spark.createDataFrame(list(rows), "date string, passport_num string").withColumn("date", F.col("date").cast("date"))


def report(wh):
    return sorted(tuple(map(str, r)) for r in wh.report().select("report_dt", "event_type", "event_dt", "passport").collect())


def recomputed(wh):
    full, _ = P.report_frame(wh, None, (1, 2, 3, 4))
    return sorted(tuple(map(str, r)) for r in full.select("report_dt", "event_type", "event_dt", "passport").collect())


@pytest.fixture()
def wh(spark, workdir):
    return P.Warehouse(spark, os.path.join(workdir, "wh"))


def test_tables_without_rows(spark, wh):
    people(spark, wh, ALL)
    none = B.tx(spark, [])
    P.run_date(wh, "2024-03-01", RUN, {
        "terminals": terms(spark, ("A", "a")), "transactions": none, "passport_blacklist": listing(spark, ("2024-02-28", "P1")),
    })
    assert wh.read("fact", "transactions").count() == wh.read("fact", "passport_blacklist").count() == wh.report().count() == 0
    P.run_date(wh, "2024-03-02", RUN, {
        "terminals": terms(spark, ("A", "a")), "transactions": B.tx(spark, [("t1", "2024-03-02 10:00:00", 1, "C1", "SUCCESS", "A")]),
        "passport_blacklist": listing(spark, ("2024-02-28", "P1"), ("2024-03-02", "P1")),
    })
    assert [r[:2] for r in report(wh)] == [("2024-03-02", "1")]
    assert wh.read("fact", "passport_blacklist").count() == 1


def test_watermarks_survive_a_stop(spark, wh):
    people(spark, wh, ALL)
    before = P.source_watermark(wh, "clients")
    publish = P.Warehouse.publish
    try:
        P.Warehouse.publish = lambda self, dim, m, kind="hist": (_ for _ in ()).throw(RuntimeError("stopped")) if kind == "meta" else publish(self, dim, m, kind)
        with pytest.raises(RuntimeError):
            wh.write_watermarks(wh.watermarks().limit(0))
    finally:
        P.Warehouse.publish = publish
    assert before is not None and P.source_watermark(wh, "clients") == before
    people(spark, wh, [("C1", "P9", "2030-01-01", "2030-01-01")], "2024-02-02 00:00:00", "2024-02-01 00:00:00")
    assert P.source_watermark(wh, "clients") > before


def test_a_late_file_reruns_the_next_day(spark, wh):
    people(spark, wh, ALL)
    P.run_date(wh, "2024-03-01", RUN, {"terminals": terms(spark, ("A", "a"), ("B", "b")), "passport_blacklist": listing(spark)})
    P.run_date(wh, "2024-03-02", RUN, {
        "terminals": terms(spark, ("A", "a"), ("B", "b")), "passport_blacklist": listing(spark),
        "transactions": [("f2", B.tx(spark, [("t2", "2024-03-02 00:10:00", 1, "C1", "SUCCESS", "B")]))],
    })
    assert report(wh) == []
    P.run_date(wh, "2024-03-01", RUN, {"transactions": [("f1", B.tx(spark, [("t1", "2024-03-01 23:50:00", 1, "C1", "SUCCESS", "A")]))]})
    assert [r[:2] for r in report(wh)] == [("2024-03-02", "3")] and report(wh) == recomputed(wh)
    # the corrected file no longer has the operation: the hit goes
    P.run_date(wh, "2024-03-01", RUN, {"transactions": [("f1", B.tx(spark, []))]})
    assert report(wh) == recomputed(wh) == []


def test_a_late_listing_reruns_the_days_it_touches(spark, wh, monkeypatch):
    people(spark, wh, ALL)
    for day in ("01", "02", "03", "04"):
        who = {"01": "C1", "02": "C2", "03": "C1", "04": "C3"}[day]
        P.run_date(wh, f"2024-03-{day}", RUN, {
            "transactions": [(f"f{day}", B.tx(spark, [(f"t{day}", f"2024-03-{day} 10:00:00", 1, who, "SUCCESS", "A")]))],
            "terminals": terms(spark, ("A", "a")), "passport_blacklist": [(f"b{day}", listing(spark))],
        })
    ran = []
    run_rules = P.run_rules
    monkeypatch.setattr(P, "run_rules", lambda wh, days, rules: ran.append((tuple(map(str, days)), tuple(rules))) or run_rules(wh, days, rules))
    P.run_date(wh, "2024-03-02", RUN, {"passport_blacklist": [("late", listing(spark, ("2024-03-02", "P1")))]})
    assert [r[:2] for r in report(wh)] == [("2024-03-03", "1")] and report(wh) == recomputed(wh)
    assert ran == [(("2024-03-02",) * 2, (1, 2, 3, 4)), (("2024-03-03",) * 2, (1,))]


def test_a_corrected_client_reruns_the_days_it_touches(spark, wh, monkeypatch):
    people(spark, wh, ALL)
    for n, day in enumerate(("01", "02", "03", "04")):
        P.run_date(wh, f"2024-03-{day}", RUN, {
            "transactions": [(f"f{day}", B.tx(spark, [(f"t{day}", f"2024-03-{day} 10:00:00", 1, "C1" if n % 2 else "C2", "SUCCESS", "A")]))],
            "terminals": terms(spark, ("A", "a")), "passport_blacklist": [(f"b{day}", listing(spark))],
        })
    assert report(wh) == []
    ran = []
    run_rules = P.run_rules
    monkeypatch.setattr(P, "run_rules", lambda wh, days, rules: ran.append(tuple(map(str, days))) or run_rules(wh, days, rules))
    # C1's passport had run out, valid from the third on: of C1's days only the fourth is touched
    people(spark, wh, [("C1", "P1", "2024-01-31", "2030-01-01")], "2024-03-08 00:00:00", "2024-03-03 00:00:00")
    assert set(ran) == {("2024-03-04", "2024-03-04")}
    assert [r[:2] for r in report(wh)] == [("2024-03-04", "1")] and report(wh) == recomputed(wh)


def test_random_arrival_equals_the_full_recompute(spark, wh):
    rng = random.Random(4)
    people(spark, wh, ALL)
    days = ["2024-03-01", "2024-03-02"]
    files = []
    for d in days:
        rows = [
            (f"{d}-{i}", f"{d} {rng.choice(['00:05', '00:40', '12:00', '23:30', '23:55'])}:0{i}", 100 - 7 * i, rng.choice(["C1", "C2"]),
             rng.choice(["SUCCESS", "REJECT"]), rng.choice(["A", "B"])) for i in range(8)
        ]
        files += [(d, "transactions", B.tx(spark, rows[:4]), 0), (d, "transactions", B.tx(spark, rows[4:]), 1)]
        files += [(d, "terminals", terms(spark, ("A", rng.choice("ab")), ("B", "b")), 0), (d, "passport_blacklist", listing(spark, (d, f"P{1 + days.index(d)}")), 0)]
    rng.shuffle(files)
    for d, kind, rows, n in files:
        P.run_date(wh, d, RUN, {kind: [(f"{kind}-{d}-{n}", rows)]})
    assert report(wh) == recomputed(wh) and len(report(wh)) > 1


# ------------------------------------------------------------------ snapshots and merges

COLUMNS = ["terminal_id", "terminal_city", "effective_from", "effective_to", "deleted_flg", "file_date"]


def history(wh):
    return sorted(tuple(map(str, r)) for r in wh.history("terminals").select(*COLUMNS).collect())


@pytest.mark.parametrize("seed", range(2))
def test_snapshots_in_any_order(spark, workdir, seed):
    rng = random.Random(seed)
    days = [f"2024-03-{d:02d}" for d in (1, 2, 4, 7, 8)]
    snaps = {d: [(t, rng.choice("xy")) for t in "ABC" if rng.random() < 0.6] or [("A", "x")] for d in days}
    wanted = P.Warehouse(spark, os.path.join(workdir, "sorted"))
    for d in days:
        P.merge_terminals(wanted, terms(spark, *snaps[d]), d)
    order = days[:]
    while order == days:
        rng.shuffle(order)
    mixed = P.Warehouse(spark, os.path.join(workdir, "mixed"))
    for d in order:
        if rng.random() < 0.3:  # a first version of the day's snapshot, corrected at once
            P.merge_terminals(mixed, terms(spark, ("Z", "z")), d)
        P.merge_terminals(mixed, terms(spark, *snaps[d]), d)
    assert history(mixed) == history(wanted)


def test_the_stream_goes_on_after_a_late_snapshot(spark, workdir):
    from tallyhawk.streaming import file_stream as FST

    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    for n, (day, city) in enumerate([("05", "a"), ("02", "b"), ("06", "c")]):
        with open(f"{drop}/terminals_{day}032024.txt", "w") as f:
            f.write(f"terminal_id;terminal_type;terminal_city;terminal_address\nA;ATM;{city};x\n")
        os.utime(f"{drop}/terminals_{day}032024.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    FST.run_available(FST.terminals_stream(spark, drop), P.terminals_batch_writer(wh), os.path.join(workdir, "cp"))
    assert {r[1:4] for r in history(wh)} == {("b", "2024-03-02", "2024-03-04"), ("a", "2024-03-05", "2024-03-05"), ("c", "2024-03-06", INF)}


def test_rows_without_a_key_and_repeated_first_rows(spark):
    empty = S.empty_history(spark, {"k": "string"}, {"v": "string"}, "day", {"file_date": "date"})
    snap = spark.createDataFrame([(None, "a"), ("x", "b")], "k string, v string")
    extras = {"file_date": F.lit("2024-03-01").cast("date")}
    once = S.scd2_merge_snapshot(empty, snap, "k", ["v"], "2024-03-01", extras=extras)
    twice = S.scd2_merge_snapshot(once, snap, "k", ["v"], "2024-03-02", extras=extras)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) and once.count() == 1
    rows = spark.sql(
        "select * from values ('x', 'old', timestamp_ntz'2024-01-01 00:00:00', null), ('x', 'new', timestamp_ntz'2024-01-01 00:00:00',"
        " timestamp_ntz'2024-01-05 00:00:00'), ('gone', 'g', timestamp_ntz'2024-01-01 00:00:00', null),"
        " (null, 'n', timestamp_ntz'2024-01-01 00:00:00', null) t(k, v, create_dt, update_dt)"
    )
    first = S.scd2_initial(rows, "k", ["v"], RUN, live_keys=spark.createDataFrame([("x",)], "k string"))
    assert [(r["k"], r["v"]) for r in first.collect()] == [("x", "new")]


def test_history_diff_names_the_changed_intervals(spark):
    def hist(*rows):
        return spark.sql("select * from values " + ", ".join(
            f"('{k}', {'null' if v is None else repr(v)}, date'{a}', date'{b}', 'N')" for k, v, a, b in rows
        ) + " t(k, v, effective_from, effective_to, deleted_flg)")

    old = hist(("a", None, "2024-01-01", INF), ("b", "x", "2024-01-01", "2024-02-01"), ("c", "y", "2024-01-01", INF))
    new = hist(("a", None, "2024-01-01", "2024-03-01"), ("a", "z", "2024-03-02", INF), ("b", "x", "2024-01-01", "2024-02-01"), ("c", "y", "2024-01-01", INF))
    got = sorted(tuple(map(str, r)) for r in AF.history_diff(old, new, ["k"], ["v"], "day").collect())
    assert got == [("a", "2024-03-02", INF), ("a", "2024-03-02", INF)]


def test_days_reached_by_windows(spark):
    tx = B.tx(spark, [("t", "2024-03-01 23:30:00", 1, "C", "SUCCESS", "A"), ("u", "2024-03-05 10:00:00", 1, "C", "SUCCESS", "A")])
    got = {(str(r["report_dt"])[-2:], r["event_type"]) for r in AF.days_of_operations(tx).collect()}
    assert got == {("01", 1), ("01", 2), ("01", 3), ("02", 3), ("01", 4), ("05", 1), ("05", 2), ("05", 3), ("05", 4)}


def test_reports_of_the_rules_stay_apart(spark, wh):
    """A rerun of one rule leaves the rows of the others."""
    people(spark, wh, [("C1", "P1", "2024-01-01", "2024-01-01")] + ALL[1:])
    P.run_date(wh, "2024-03-01", RUN, {"transactions": [("f", B.tx(spark, [("t", "2024-03-01 10:00:00", 1, "C1", "SUCCESS", "A")]))],
                                       "passport_blacklist": [("b", listing(spark))]})
    before = report(wh)
    P.rerun(wh, {(dt.date(2024, 3, 1), 2)})
    assert report(wh) == before and {r[1] for r in before} == {"1", "2"}
    assert R.report_summary(wh.report()).count() == 2
