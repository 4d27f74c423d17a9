"""Golden cases for the four rules (FIXTURES.md section 2.1-2.4)."""

import datetime as dt

import builders as B
from pyspark.sql import functions as F

from tallyhawk.operators import rules as R

D = "2024-03-10"
DAY = (D, D)


def _events(df):
    return sorted((r["event_dt"].isoformat(sep=" "), r["passport"], r["report_dt"].isoformat()) for r in df.collect())


# ------------------------------------------------------------------ rule 1


def _rule1(spark, passport_valid_to, blacklist_rows, day=DAY):
    dims = B.simple_dims(spark, [("1", "P1", passport_valid_to, "2030-01-01")])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "T1")])
    bl = B.blacklist(spark, blacklist_rows) if blacklist_rows else B.blacklist(spark, [("PX", "2020-01-01")])
    rows = R.rule_passport(tx, dims, bl, day).collect()
    _same_as_fused(spark, rows, tx, dims, bl, day, 1)
    return rows


def _same_as_fused(spark, rows, tx, dims, bl, day, rule, terms=None, **kw):
    """The fused report path must give the same rows as the single rule."""
    terms = terms if terms is not None else B.terminals(spark, [("Z", "Z", "2020-01-01", "9999-12-31", "N", "2020-01-01")])
    fused = R.fraud_report(tx, dims, terms, bl, day, rules=(rule,), **kw).collect()
    key = lambda r: (r["event_dt"], r["passport"], r["fio"], r["phone"], r["event_type"], r["report_dt"])
    assert sorted(map(key, fused)) == sorted(map(key, rows))


def test_1a_passport_valid_through_its_last_day(spark):
    assert _rule1(spark, D, None) == []


def test_1b_passport_expired_day_before(spark):
    rows = _rule1(spark, "2024-03-09", None)
    assert len(rows) == 1 and rows[0]["event_type"] == 1 and rows[0]["passport"] == "P1"
    assert rows[0]["report_dt"] == dt.date(2024, 3, 10)


def test_1c_blacklisted_same_day(spark):
    assert len(_rule1(spark, "2030-01-01", [("P1", D)])) == 1


def test_1d_blacklisted_next_day(spark):
    assert _rule1(spark, "2030-01-01", [("P1", "2024-03-11")]) == []


def test_1e_expired_and_blacklisted_once(spark):
    assert len(_rule1(spark, "2024-01-01", [("P1", "2024-01-01"), ("P1", "2024-02-01")])) == 1


def test_1f_null_validity_is_infinite(spark):
    from tallyhawk.plans.warehouse import stage_clients

    dims = B.simple_dims(spark, [("1", "P1", None, "2030-01-01")])
    dims.clients = stage_clients(dims.clients)
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "T1")])
    assert R.rule_passport(tx, dims, B.blacklist(spark, [("PX", "2020-01-01")]), DAY).collect() == []


def test_1g_old_version_blacklisted_new_passport_clean(spark):
    c = B.cards(spark, [("1", "1", B.TS0, B.INF_TS, "N")])
    a = B.accounts(spark, [("1", "2030-01-01", "1", B.TS0, B.INF_TS, "N")])
    p = B.clients(spark, [
        ("1", "L", "F", "M", "OLD", "2030-01-01", "+1", B.TS0, "2024-03-01 09:59:59.999", "N"),
        ("1", "L", "F", "M", "NEW", "2030-01-01", "+1", "2024-03-01 10:00:00", B.INF_TS, "N"),
    ])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "T1")])
    bl = B.blacklist(spark, [("OLD", "2024-01-01")])
    assert R.rule_passport(tx, R.Dimensions(c, a, p), bl, DAY).collect() == []


def test_1h_two_card_versions_one_row(spark):
    c = B.cards(spark, [
        ("1", "1", B.TS0, "2024-03-05 00:00:00", "N"),
        ("1", "1", "2024-03-05 00:00:00.001", B.INF_TS, "N"),
    ])
    a = B.accounts(spark, [("1", "2030-01-01", "1", B.TS0, B.INF_TS, "N")])
    p = B.clients(spark, [("1", "L", "F", "M", "P1", "2024-01-01", "+1", B.TS0, B.INF_TS, "N")])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "T1")])
    assert len(R.rule_passport(tx, R.Dimensions(c, a, p), B.blacklist(spark, [("PX", "2020-01-01")]), DAY).collect()) == 1


# ------------------------------------------------------------------ rule 2


def _rule2(spark, contract_valid_to, dims=None):
    dims = dims or B.simple_dims(spark, [("1", "P1", "2030-01-01", contract_valid_to)])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "T1")])
    rows = R.rule_contract(tx, dims, DAY).collect()
    _same_as_fused(spark, rows, tx, dims, B.blacklist(spark, [("PX", "2020-01-01")]), DAY, 2)
    return rows


def test_2a_contract_valid_through_its_last_day(spark):
    assert _rule2(spark, D) == []


def test_2b_contract_ended_day_before(spark):
    rows = _rule2(spark, "2024-03-09")
    assert len(rows) == 1 and rows[0]["event_type"] == 2 and rows[0]["fio"] == "Last First Middle"


def test_2c_account_deleted_at_operation(spark):
    c = B.cards(spark, [("1", "1", B.TS0, B.INF_TS, "N")])
    a = B.accounts(spark, [
        ("1", "2024-01-01", "1", B.TS0, "2024-03-01 23:59:59.999", "N"),
        ("1", "2024-01-01", "1", "2024-03-02 00:00:00", B.INF_TS, "Y"),
    ])
    p = B.clients(spark, [("1", "L", "F", "M", "P1", "2030-01-01", "+1", B.TS0, B.INF_TS, "N")])
    assert _rule2(spark, None, R.Dimensions(c, a, p)) == []


def test_2d_unknown_client_keeps_row(spark):
    c = B.cards(spark, [("1", "1", B.TS0, B.INF_TS, "N")])
    a = B.accounts(spark, [("1", "2024-01-01", "404", B.TS0, B.INF_TS, "N")])
    p = B.clients(spark, [("1", "L", "F", "M", "P1", "2030-01-01", "+1", B.TS0, B.INF_TS, "N")])
    rows = _rule2(spark, None, R.Dimensions(c, a, p))
    assert len(rows) == 1 and rows[0]["passport"] is None and rows[0]["fio"] is None and rows[0]["phone"] is None


def test_2e_null_part_of_name_gives_null_fio(spark):
    c = B.cards(spark, [("1", "1", B.TS0, B.INF_TS, "N")])
    a = B.accounts(spark, [("1", "2024-01-01", "1", B.TS0, B.INF_TS, "N")])
    p = B.clients(spark, [("1", "L", "F", None, "P1", "2030-01-01", "+1", B.TS0, B.INF_TS, "N")])
    rows = _rule2(spark, None, R.Dimensions(c, a, p))
    assert len(rows) == 1 and rows[0]["fio"] is None and rows[0]["passport"] == "P1"


# ------------------------------------------------------------------ rule 3

TERMS = [
    ("A1", "A", "2020-01-01", "9999-12-31", "N", "2020-01-01"),
    ("B1", "B", "2020-01-01", "9999-12-31", "N", "2020-01-01"),
    ("A2", "A", "2020-01-01", "9999-12-31", "N", "2020-01-01"),
]


def _rule3(spark, ops, terms=TERMS, day=DAY):
    dims = B.simple_dims(spark, [("1", "P1", "2030-01-01", "2030-01-01"), ("2", "P2", "2030-01-01", "2030-01-01")])
    tx = B.tx(spark, [(f"t{i}", ts, 10, card, "SUCCESS", term) for i, (ts, card, term) in enumerate(ops)])
    rows = R.rule_city_hop(tx, B.terminals(spark, terms), dims, day).collect()
    _same_as_fused(spark, rows, tx, dims, B.blacklist(spark, [("PX", "2020-01-01")]), day, 3, B.terminals(spark, terms))
    return sorted(r["event_dt"].strftime("%H:%M:%S.%f") for r in rows)


def test_3a_one_hour_inclusive(spark):
    assert _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 11:00:00", "1", "B1")]) == ["11:00:00.000000"]


def test_3b_just_over_one_hour(spark):
    assert _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 11:00:00.001", "1", "B1")]) == []


def test_3c_same_city(spark):
    assert _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:30:00", "1", "A2")]) == []


def test_3d_back_and_forth(spark):
    got = _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:20:00", "1", "B1"), (f"{D} 10:40:00", "1", "A2")])
    assert got == ["10:20:00.000000", "10:40:00.000000"]


def test_3e_unknown_terminal_skipped(spark):
    got = _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:10:00", "1", "ZZ"), (f"{D} 10:20:00", "1", "B1")])
    assert got == ["10:20:00.000000"]


def test_3f_predecessor_on_previous_day(spark):
    got = _rule3(spark, [("2024-03-09 23:40:00", "1", "A1"), (f"{D} 00:10:00", "1", "B1")])
    assert got == ["00:10:00.000000"]


def test_3g_terminal_moves_on_the_day(spark):
    terms = [
        ("M", "A", "2020-01-01", "2024-03-09", "N", "2020-01-01"),
        ("M", "B", "2024-03-10", "9999-12-31", "N", "2024-03-10"),
    ]
    got = _rule3(spark, [("2024-03-09 23:50:00", "1", "M"), (f"{D} 00:20:00", "1", "M")], terms)
    assert got == ["00:20:00.000000"]


def test_3h_different_cards(spark):
    assert _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:10:00", "2", "B1")]) == []


# ------------------------------------------------------------------ rule 4


def _rule4(spark, ops, day=DAY):
    dims = B.simple_dims(spark, [("1", "P1", "2030-01-01", "2030-01-01")])
    tx = B.tx(spark, [(f"t{i}", ts, amt, "1", res, "A1") for i, (ts, amt, res) in enumerate(ops)])
    rows = R.rule_amount_probe(tx, dims, day).collect()
    _same_as_fused(spark, rows, tx, dims, B.blacklist(spark, [("PX", "2020-01-01")]), day, 4)
    return sorted(r["event_dt"].strftime("%d %H:%M:%S.%f") for r in rows)


S, J = "SUCCESS", "REJECT"


def test_4a_twenty_minutes_inclusive(spark):
    ops = [(f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, J), (f"{D} 10:10:00", 80, J), (f"{D} 10:20:00", 70, S)]
    assert _rule4(spark, ops) == ["10 10:20:00.000000"]


def test_4b_just_over_twenty_minutes(spark):
    ops = [(f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, J), (f"{D} 10:10:00", 80, J), (f"{D} 10:20:00.001", 70, S)]
    assert _rule4(spark, ops) == []


def test_4c_needs_more_than_three_operations(spark):
    ops = [(f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, J), (f"{D} 10:10:00", 80, S)]
    assert _rule4(spark, ops) == []


def test_4d_strictly_falling(spark):
    ops = [(f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, J), (f"{D} 10:06:00", 90, J), (f"{D} 10:10:00", 70, S)]
    assert _rule4(spark, ops) == []


def test_4e_longer_chain_one_hit(spark):
    ops = [(f"{D} 09:30:00", 110, J), (f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, J),
           (f"{D} 10:10:00", 80, J), (f"{D} 10:15:00", 70, S)]
    assert _rule4(spark, ops) == ["10 10:15:00.000000"]


def test_4f_success_inside_chain(spark):
    ops = [(f"{D} 10:00:00", 100, J), (f"{D} 10:05:00", 90, S), (f"{D} 10:10:00", 80, J), (f"{D} 10:15:00", 70, S)]
    assert _rule4(spark, ops) == []


def test_4g_chain_over_midnight(spark):
    ops = [("2024-03-09 23:50:00", 100, J), ("2024-03-09 23:55:00", 90, J), ("2024-03-09 23:59:00", 80, J),
           (f"{D} 00:05:00", 70, S)]
    assert _rule4(spark, ops) == ["10 00:05:00.000000"]


def test_operations_without_a_card_are_no_sequence(spark):
    hops = [(f"{D} 10:00:00", None, "A1"), (f"{D} 10:30:00", None, "B1"), (f"{D} 11:00:00", "1", "A1"), (f"{D} 11:30:00", "1", "B1")]
    assert _rule3(spark, hops) == ["11:30:00.000000"]
    tx = B.tx(spark, [(f"t{i}", ts, 100 - i, card, S if i % 4 == 3 else J, term) for i, (ts, card, term) in enumerate(
        [(f"{D} 10:0{i}:00", None, "A1") for i in range(4)] + hops[:2])])
    dims = B.simple_dims(spark, [("1", "P1", "2030-01-01", "2030-01-01")])
    rep = R.fraud_report(tx, dims, B.terminals(spark, TERMS), B.blacklist(spark, [("PX", "2020-01-01")]), DAY)
    assert rep.collect() == []


def test_report_columns_and_union(spark):
    dims = B.simple_dims(spark, [("1", "P1", "2024-01-01", "2024-01-01")])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "A1")])
    rep = R.fraud_report(tx, dims, B.terminals(spark, TERMS), B.blacklist(spark, [("P1", "2024-01-01")]), DAY)
    assert rep.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert sorted(r["event_type"] for r in rep.collect()) == [1, 2]
    summary = R.report_summary(rep).orderBy("event_type").collect()
    assert [(r["event_type"], r["n_events"]) for r in summary] == [(1, 1), (2, 1)]


def test_seed_event_type(spark):
    from tallyhawk.operators import quality as Q

    seed = R.event_types(spark)
    assert [r["event_type"] for r in seed.orderBy("event_type").collect()] == [1, 2, 3, 4]
    assert Q.duplicate_keys(seed, "event_type").count() == 0
    dims = B.simple_dims(spark, [("1", "P1", "2024-01-01", "2024-01-01")])
    tx = B.tx(spark, [("t1", f"{D} 12:00:00", 10, "1", "SUCCESS", "A1")])
    rep = R.fraud_report(tx, dims, B.terminals(spark, TERMS), B.blacklist(spark, [("P1", "2024-01-01")]), DAY)
    assert Q.orphans(rep, seed, "event_type", "event_type").count() == 0


def test_3i_versions_loaded_after_the_day_are_ignored(spark):
    # the only version of terminal L was loaded on 03-12, after the operations of 03-10
    terms = TERMS + [("L", "Z", "2024-03-01", "9999-12-31", "N", "2024-03-12")]
    got = _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:10:00", "1", "L"), (f"{D} 10:20:00", "1", "B1")], terms)
    assert got == ["10:20:00.000000"]


def test_3j_deleted_terminal_version_is_unknown(spark):
    terms = TERMS + [("G", "Z", "2020-01-01", "9999-12-31", "Y", "2020-01-01")]
    got = _rule3(spark, [(f"{D} 10:00:00", "1", "A1"), (f"{D} 10:10:00", "1", "G")], terms)
    assert got == []
