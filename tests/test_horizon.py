"""Bucketed sequence windows equal plain per-card windows (brute force),
including a hot card, tiny buckets, ties and daily runs."""

import random

import builders as B
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhawk.operators import rules as R

TERMS = [("T%d" % k, "C%d" % (k % 3), "2020-01-01", "9999-12-31", "N", "2020-01-01") for k in range(6)]


def _random_ops(seed, n=1500, hot_share=0.34):
    rnd = random.Random(seed)
    ops = []
    base = 1_700_000_000  # seconds
    for i in range(n):
        card = "HOT" if rnd.random() < hot_share else "c%d" % rnd.randint(1, 30)
        # bursts of close operations, ties on the second included
        t = base + rnd.randint(0, 3 * 86400)
        if rnd.random() < 0.3 and ops:
            t = int(ops[-1][1]) + rnd.choice([0, 0, 30, 300, 1200, 3600, 3601])
            card = ops[-1][3]
        res = "REJECT" if rnd.random() < 0.6 else "SUCCESS"
        ops.append(("x%05d" % i, t, rnd.randint(1, 500), card, res, "T%d" % rnd.randint(0, 6)))
    return ops


def _tx(spark, ops):
    import datetime as dt

    rows = [(i, dt.datetime.fromtimestamp(t, dt.UTC).strftime("%Y-%m-%d %H:%M:%S"), a, c, r, term) for i, t, a, c, r, term in ops]
    return B.tx(spark, rows)


def _brute_city(tx, terms, window_seconds):
    t = R.resolve_terminal_city(tx.select("trans_id", "trans_date", "card_num", "terminal"), terms)
    w = Window.partitionBy("card_num").orderBy("trans_date", "trans_id")
    t = t.withColumn("pt", F.lag("trans_date").over(w)).withColumn("pc", F.lag("city").over(w))
    hit = (F.col("pt") >= F.col("trans_date") - F.expr(f"INTERVAL '{window_seconds}' SECOND")) & (F.col("city") != F.col("pc"))
    return sorted(r["trans_id"] for r in t.filter(hit).collect())


def _brute_probe(tx, window_seconds, n=3):
    w = Window.partitionBy("card_num").orderBy("trans_date", "trans_id")
    t = tx
    for k in range(1, n + 1):
        t = t.withColumn(f"r{k}", F.lag("oper_result", k).over(w)).withColumn(f"a{k}", F.lag("amt", k).over(w))
    t = t.withColumn("t3", F.lag("trans_date", n).over(w))
    cond = (F.col("oper_result") == "SUCCESS") & (F.col("t3") >= F.col("trans_date") - F.expr(f"INTERVAL '{window_seconds}' SECOND"))
    prev = F.col("amt")
    for k in range(1, n + 1):
        cond = cond & (F.col(f"r{k}") == "REJECT") & (F.col(f"a{k}") > prev)
        prev = F.col(f"a{k}")
    return sorted(r["trans_id"] for r in t.filter(cond).collect())


def test_city_hop_buckets_match_brute_force(spark):
    tx = _tx(spark, _random_ops(1)).cache()
    terms = B.terminals(spark, TERMS)
    for window, bucket in [(3600, None), (3600, 3600), (3600, 600), (7200, 86400)]:
        got = sorted(r["trans_id"] for r in R.city_hop_hits(tx, terms, None, window, bucket).collect())
        assert got == _brute_city(tx, terms, window), (window, bucket)
        assert got, "fixture should produce hits"


def test_amount_probe_buckets_match_brute_force(spark):
    tx = _tx(spark, _random_ops(2)).cache()
    for window, bucket in [(1200, None), (1200, 300), (86400, None), (86400, 7200)]:
        got = sorted(r["trans_id"] for r in R.amount_probe_hits(tx, None, window, 3, bucket).collect())
        assert got == _brute_probe(tx, window), (window, bucket)
        if window == 86400:
            assert got, "fixture should produce hits"


def test_daily_runs_union_equals_all_days(spark):
    import datetime as dt

    tx = _tx(spark, _random_ops(3)).cache()
    terms = B.terminals(spark, TERMS)
    days = sorted({r["d"] for r in tx.select(F.to_date("trans_date").alias("d")).distinct().collect()})
    daily_city, daily_probe = [], []
    for d in days:
        daily_city += [r["trans_id"] for r in R.city_hop_hits(tx, terms, (d, d)).collect()]
        daily_probe += [r["trans_id"] for r in R.amount_probe_hits(tx, (d, d), 86400).collect()]
    assert sorted(daily_city) == sorted(r["trans_id"] for r in R.city_hop_hits(tx, terms, None).collect())
    assert sorted(daily_probe) == sorted(r["trans_id"] for r in R.amount_probe_hits(tx, None, 86400).collect())
    assert isinstance(days[0], dt.date)


def test_day_range_prunes_the_scan(spark):
    tx = _tx(spark, _random_ops(4))
    plan = R.amount_probe_hits(tx, ("2023-11-15", "2023-11-15"), 1200)._jdf.queryExecution().optimizedPlan().toString()
    assert "trans_date" in plan and ">=" in plan


def test_fused_report_equals_rule_by_rule(spark):
    import datetime as dt

    ops = _random_ops(5)
    tx = _tx(spark, ops).cache()
    terms = B.terminals(spark, TERMS)
    cards = sorted({o[3] for o in ops})
    dims = B.simple_dims(spark, [(c, "P" + c, "2023-11-15", "2023-11-16") for c in cards])
    bl = B.blacklist(spark, [("PHOT", "2023-11-15")])
    cols = ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]

    def rows(df):
        return sorted(tuple(r[c] for c in cols) for r in df.collect())

    for days in (None, (dt.date(2023, 11, 15), dt.date(2023, 11, 15))):
        fused = R.fraud_report(tx, dims, terms, bl, days, probe_window_seconds=86400)
        single = R.fraud_report_by_rule(tx, dims, terms, bl, days, probe_window_seconds=86400)
        got = rows(fused)
        assert got == rows(single)
        if days is None:
            assert {r[4] for r in got} == {1, 2, 3, 4}


def test_hot_card_path_matches_brute_force(spark):
    tx = _tx(spark, _random_ops(6)).cache()
    terms = B.terminals(spark, TERMS)
    got = sorted(r["trans_id"] for r in R.city_hop_hits(tx, terms, None, 3600).collect())
    assert got == _brute_city(tx, terms, 3600)
    got = sorted(r["trans_id"] for r in R.amount_probe_hits(tx, None, 86400, 3).collect())
    assert got == _brute_probe(tx, 86400)


def test_next_in_key_equals_plain_lead(spark):
    import datetime as dt

    from tallyhawk.operators.horizon import next_in_key

    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = "HOT" if rnd.random() < 0.4 else "k%d" % rnd.randint(1, 50)
        ts = base + dt.timedelta(seconds=rnd.choice([0, 1, 86399, 86400]) + rnd.randint(0, 40) * 86400 // 3)
        rows.append((k, ts.strftime("%Y-%m-%d %H:%M:%S"), i))
    df = spark.createDataFrame(rows, "k string, t string, tb int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    w = Window.partitionBy("k").orderBy("t", "tb")
    want = sorted((r["tb"], r["nt"], r["ntb"]) for r in df.select("tb", F.lead("t").over(w).alias("nt"), F.lead("tb").over(w).alias("ntb")).collect())
    got = next_in_key(df, ["k"], ["t", "tb"], ["t", "tb"], F.to_date("t"), prefix="n_")
    assert sorted((r["tb"], r["n_t"], r["n_tb"]) for r in got.collect()) == want
