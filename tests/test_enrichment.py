"""One-join enrichment (pre-joined levels) equals the chain of three as-of
left joins on random histories with gaps, delete markers and boundaries."""

import datetime as dt
import random

import builders as B

from tallyhawk.operators import rules as R

BASE = dt.datetime(2024, 1, 1)
INF = "9999-12-31 00:00:00"


def _fmt(t):
    return t.strftime("%Y-%m-%d %H:%M:%S.%f")


def _history(rnd, key, n_max, attrs):
    """Consecutive versions of one key: (attrs..., from, to, flag)."""
    n = rnd.randint(1, n_max)
    starts = sorted(BASE + dt.timedelta(hours=rnd.randint(0, 24 * 20)) for _ in range(n))
    starts = sorted(set(starts))
    rows = []
    for i, s in enumerate(starts):
        to = _fmt(starts[i + 1] - dt.timedelta(milliseconds=1)) if i + 1 < len(starts) else INF
        flag = "Y" if rnd.random() < 0.25 else "N"
        rows.append((key, *attrs(i), _fmt(s), to, flag))
    return rows


def _dims(spark, seed):
    rnd = random.Random(seed)
    cards, accounts, clients = [], [], []
    for c in range(25):
        cards += _history(rnd, f"c{c}", 3, lambda i: (f"a{rnd.randint(0, 14)}",))
    for a in range(15):
        accounts += [(k, "2024-01-10", cl, f, t, fl) for k, cl, f, t, fl in _history(rnd, f"a{a}", 3, lambda i: (f"p{rnd.randint(0, 11)}",))]
    for p in range(10):  # p10, p11 never exist
        clients += [(k, "L", "F", "M" if rnd.random() < 0.9 else None, pp, "2025-01-01", "+" + k, f, t, fl)
                    for k, pp, f, t, fl in _history(rnd, f"p{p}", 3, lambda i: (f"P{p}-{i}",))]
    return R.Dimensions(B.cards(spark, cards), B.accounts(spark, accounts), B.clients(spark, clients)), rnd


def test_levels_equal_chain(spark):
    for seed in (1, 2):
        dims, rnd = _dims(spark, seed)
        bounds = [r["effective_from"] for r in dims.cards.collect() + dims.accounts.collect() + dims.clients.collect()]
        ops = []
        for i in range(600):
            if i % 3 == 0:  # probe exactly on and just around version boundaries
                t = rnd.choice(bounds) + rnd.choice([dt.timedelta(0), dt.timedelta(microseconds=-1), dt.timedelta(milliseconds=-1)])
            else:
                t = BASE + dt.timedelta(seconds=rnd.randint(-3600, 22 * 86400), microseconds=rnd.randint(0, 999999))
            ops.append((f"t{i}", _fmt(t), 1, f"c{rnd.randint(0, 27)}", "SUCCESS", "T"))
        tx = B.tx(spark, ops).cache()
        cols = ["trans_id", "_a_valid_to", "_a_client", "_p_passport", "_p_fio", "_p_phone"]

        def rows(df):
            return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())

        levels = rows(R.enrich_transactions(tx, dims, how="left"))
        chain = rows(R.enrich_transactions_chain(tx, dims, how="left"))
        assert len(levels) == 600
        assert levels == chain
        assert rows(R.enrich_transactions(tx, dims, how="inner")) == rows(R.enrich_transactions_chain(tx, dims, how="inner"))
        # the fixture exercises every level
        assert any(r[3] is not None for r in levels) and any(r[1] is not None and r[3] is None for r in levels)
        assert any(r[1] is None for r in levels)


def test_uncovered_parts_brute_force(spark):
    from tallyhawk.operators.asof import uncovered_parts

    rnd = random.Random(3)
    us = dt.timedelta(microseconds=1)
    left, right = [], []
    for k in range(8):
        for j in range(rnd.randint(1, 3)):
            a = BASE + dt.timedelta(hours=rnd.randint(0, 100))
            left.append((f"k{k}", j, a, a + dt.timedelta(hours=rnd.randint(0, 40), microseconds=rnd.randint(0, 5))))
        t = BASE - dt.timedelta(hours=10)
        for _ in range(rnd.randint(0, 4)):  # non-overlapping right intervals of the key
            s = t + dt.timedelta(hours=rnd.randint(0, 30), microseconds=rnd.randint(0, 3))
            e = s + dt.timedelta(hours=rnd.randint(0, 20), microseconds=rnd.randint(0, 3))
            right.append((f"k{k}", s, e))
            t = e + us
    L = spark.createDataFrame(left, "k string, lid int, f timestamp_ntz, t timestamp_ntz")
    R = spark.createDataFrame(right, "rk string, rf timestamp_ntz, rt timestamp_ntz") if right else None
    got = uncovered_parts(L, R, ["k", "lid"], "k", "rk", "f", "t", "rf", "rt").collect()
    pieces = {}
    for r in got:
        pieces.setdefault((r["k"], r["lid"]), []).append((r["f"], r["t"]))
    probes = {x + d for (_, _, a, b) in left for x in (a, b) for d in (-us, dt.timedelta(0), us)}
    probes |= {x + d for (_, a, b) in right for x in (a, b) for d in (-us, dt.timedelta(0), us)}
    for k, lid, a, b in left:
        ps = pieces.get((k, lid), [])
        for t in probes:
            inside = a <= t <= b and not any(rk == k and rf <= t <= rt for rk, rf, rt in right)
            assert inside == any(f <= t <= e for f, e in ps), (k, lid, t)
        ps = sorted(ps)
        assert all(ps[i][1] < ps[i + 1][0] for i in range(len(ps) - 1))  # disjoint pieces
