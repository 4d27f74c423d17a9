"""Randomised multi-run incremental merges keep every SCD2 invariant and
"""

import datetime as dt
import random

from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.operators import quality as Q
from tallyhawk.operators import scd2 as S
from tallyhawk.operators import state as ST

BASE = dt.datetime(2024, 1, 1, 6, 0)


def _fmt(t):
    return None if t is None else t.strftime("%Y-%m-%d %H:%M:%S")


def _source_df(spark, state):
    rows = [(k, v, _fmt(c), _fmt(u)) for k, (v, c, u) in sorted(state.items())]
    df = spark.createDataFrame(rows, "id string, v string, create_dt string, update_dt string")
    return df.select("id", "v", F.col("create_dt").cast("timestamp_ntz").alias("create_dt"), F.col("update_dt").cast("timestamp_ntz").alias("update_dt"))


def test_random_runs_keep_invariants(spark):
    for seed in (11, 12):
        rnd = random.Random(seed)
        state = {}  # key -> (value, create, update)
        ever = set()
        hist = S.empty_history(spark, {"id": "string"}, {"v": "string"}, grain="ms", extras={"processed_dt": "timestamp_ntz"})
        meta = spark.createDataFrame([], "schema_name string, table_name string, max_update_dt timestamp_ntz")
        for run in range(6):
            run_ts = BASE + dt.timedelta(days=run, hours=12)
            change_t = BASE + dt.timedelta(days=run, hours=rnd.randint(0, 11), minutes=rnd.randint(0, 59))
            for k in [f"k{i}" for i in range(30)]:
                r = rnd.random()
                if k in state:
                    v, c, u = state[k]
                    if r < 0.15:
                        del state[k]  # deleted at the source
                    elif r < 0.45:
                        state[k] = (rnd.choice(["a", "b", None]), c, change_t)  # updated (maybe to NULL)
                elif r < 0.3:
                    if k in ever:
                        state[k] = (rnd.choice(["a", "c"]), BASE - dt.timedelta(days=30), change_t)  # restored
                    else:
                        state[k] = (rnd.choice(["a", "b"]), change_t, None)  # new
            ever |= set(state)
            src = _source_df(spark, state)
            wm = ST.watermark_lookup(meta, "t") if run else None
            changed = ST.incremental_extract(src, wm)
            hist = (
                S.scd2_merge_incremental(hist, changed, src.select("id"), "id", ["v"], _fmt(run_ts)).cache()
            )
            meta = ST.advance_watermark(meta, {"t": changed}, schema="source").cache()

            rows = hist.collect()
            open_rows = [r for r in rows if r["effective_to"] == dt.datetime(9999, 12, 31)]
            live = {r["id"]: r["v"] for r in open_rows if r["deleted_flg"] == "N"}
            assert live == {k: v for k, (v, _, _) in state.items()}, (seed, run)
            assert {r["id"] for r in open_rows if r["deleted_flg"] == "Y"} == ever - set(state), (seed, run)
            assert len(open_rows) == len({r["id"] for r in open_rows}), (seed, run)
            assert Q.validity_violations(hist, "id").count() == 0, (seed, run)
            cols = ["id", "v", "effective_from", "effective_to", "deleted_flg"]
            key = lambda t: tuple((x is None, str(x)) for x in t)
            again = sorted((tuple(r[c] for c in cols) for r in S.scd2_close(hist, "id").collect()), key=key)
            assert again == sorted((tuple(r[c] for c in cols) for r in rows), key=key), (seed, run)


def test_random_snapshots_keep_invariants(spark):
    rnd = random.Random(21)
    hist = S.empty_history(spark, {"id": "string"}, {"v": "string"}, grain="day")
    ever = set()
    day0 = dt.date(2024, 3, 1)
    for i in range(6):
        day = day0 + dt.timedelta(days=i * rnd.randint(1, 3) + i)
        snap = {f"t{k}": rnd.choice(["a", "b", None]) for k in range(25) if rnd.random() < 0.7}
        ever |= set(snap)
        df = spark.createDataFrame(sorted(snap.items()), "id string, v string")
        hist = S.scd2_merge_snapshot(hist, df, "id", ["v"], str(day), grain="day").cache()
        rows = hist.collect()
        open_rows = [r for r in rows if r["effective_to"] == dt.date(9999, 12, 31)]
        assert {r["id"]: r["v"] for r in open_rows if r["deleted_flg"] == "N"} == snap, i
        assert {r["id"] for r in open_rows if r["deleted_flg"] == "Y"} == ever - set(snap), i
        assert len(open_rows) == len({r["id"] for r in open_rows}), i
        assert Q.validity_violations(hist, "id", grain="day").count() == 0, i
        cols = ["id", "v", "effective_from", "effective_to", "deleted_flg"]
        key = lambda t: tuple((x is None, str(x)) for x in t)
        again = sorted((tuple(r[c] for c in cols) for r in S.scd2_close(hist, "id", grain="day").collect()), key=key)
        assert again == sorted((tuple(r[c] for c in cols) for r in rows), key=key), i
