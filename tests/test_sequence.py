"""Sequences cut by row count: previous rows equal plain lag, the carried
as-of join equals the pairwise one, also where one key holds every row."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhawk.operators.asof import asof_join
from tallyhawk.operators import sequence as S

T0 = dt.datetime(2024, 3, 1)
OPS = "id int, card string, ts timestamp_ntz, amt int"
VERSIONS = "vk string, vfrom timestamp_ntz, vto timestamp_ntz, city string"


def _ops(seed, n, keys, span, nulls=0.05):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        card = None if rnd.random() < nulls else rnd.choice(keys)
        ts = None if rnd.random() < nulls else T0 + dt.timedelta(seconds=rnd.randint(0, span))
        rows.append((i, card, ts, rnd.choice([None, *range(50)])))
    return rows


def _versions(seed, keys, span, most):
    """Histories with gaps, versions that touch, and keys without any."""
    rnd = random.Random(seed)
    rows = []
    for k in keys:
        cuts = sorted(rnd.sample(range(-span, 2 * span), 2 * rnd.randint(0, most)))
        for i, (a, b) in enumerate(zip(cuts[::2], cuts[1::2])):
            rows.append((k, T0 + dt.timedelta(seconds=a), T0 + dt.timedelta(seconds=b), f"{k}-{i}"))
    return rows + [(None, T0, T0, "no key"), ("c1", None, T0, "no start")]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


KEYS = [
    (["HOT"], 900),  # one card, all rows within a quarter of an hour
    (["HOT"] * 20 + [f"c{i}" for i in range(30)], 86400 * 3),
    ([f"c{i}" for i in range(200)], 86400),  # fewer rows a key than depth
]


@pytest.mark.parametrize("keys,span", KEYS)
@pytest.mark.parametrize("parts", [1, 7, 40])
def test_previous_rows_equal_lag(spark, keys, span, parts):
    ops = spark.createDataFrame(_ops(3, 600, keys, span), OPS)
    got = S.with_previous(ops, "card", ["ts", "id"], ["ts", "amt"], depth=3, parts=parts)
    w = Window.partitionBy("card").orderBy(F.col("ts").asc_nulls_last(), "id")
    want = ops
    for k in (1, 2, 3):
        for v in ("ts", "amt"):
            want = want.withColumn(f"_prev{k}_{v}", F.when(F.col("card").isNotNull(), F.lag(v, k).over(w)))
    assert _rows(got.select(want.columns)) == _rows(want)


def test_one_card_of_one_day_is_spread(spark):
    ops = spark.createDataFrame(_ops(4, 4000, ["HOT"], 3600, nulls=0), OPS)
    sizes = [r["count"] for r in S.in_ranges(ops, "card", ["ts", "id"], 8).groupBy(S.PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 8 * 2


@pytest.mark.parametrize("keys,span", KEYS)
@pytest.mark.parametrize("parts", [1, 9, 40])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_carried_asof_equals_pairs(spark, keys, span, parts, how):
    ops = spark.createDataFrame(_ops(5, 500, keys, span), OPS)
    vers = spark.createDataFrame(_versions(6, sorted(set(keys)), span, 12), VERSIONS)
    args = ("card", "vk", "ts", "vfrom", "vto")
    got = S.asof_carried(ops, vers, *args, how=how, parts=parts)
    want = asof_join(ops, vers, *args, how=how)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


def test_carried_asof_by_day(spark):
    ops = spark.createDataFrame(_ops(7, 400, ["a", "b"], 86400 * 9), OPS)
    rows = [("a", dt.date(2024, 3, 2), dt.date(2024, 3, 3), "x"), ("a", dt.date(2024, 3, 4), dt.date(9999, 12, 31), "y"),
            ("b", dt.date(2024, 2, 1), dt.date(2024, 3, 5), "z")]
    vers = spark.createDataFrame(rows, "vk string, vfrom date, vto date, city string")
    args = ("card", "vk", "ts", "vfrom", "vto")
    assert _rows(S.asof_carried(ops, vers, *args, grain="day", parts=6)) == _rows(asof_join(ops, vers, *args, grain="day"))


def test_no_pairs_are_formed(spark):
    """The plan has no join of the two sides, only the look-up of edges."""
    ops = spark.createDataFrame(_ops(8, 50, ["a"], 900), OPS)
    vers = spark.createDataFrame(_versions(9, ["a"], 900, 3), VERSIONS)
    plan = S.asof_carried(ops, vers, "card", "vk", "ts", "vfrom", "vto", parts=3)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "(_part" in joins[0]


def test_empty_sides(spark):
    ops, vers = spark.createDataFrame([], OPS), spark.createDataFrame([], VERSIONS)
    one = spark.createDataFrame(_ops(1, 5, ["a"], 9, nulls=0), OPS)
    args = ("card", "vk", "ts", "vfrom", "vto")
    assert S.asof_carried(ops, vers, *args).count() == 0
    assert S.asof_carried(one, vers, *args).where("vk is null").count() == 5
    assert S.with_previous(ops, "card", ["ts", "id"], ["amt"]).count() == 0
    with pytest.raises(ValueError):
        S.asof_carried(one, vers, *args, how="full")
