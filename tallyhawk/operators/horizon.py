"""Time-bucketed window partitions with a look-back overlap.

Sequence rules ("previous operation of the same card within one hour")
are `lag` windows partitioned by card.  A window partition is processed by
one task, so one very busy card would serialise the whole job.  Here each
card's operations are split into time buckets of ``bucket_seconds``; every
row is also copied into the following buckets whose start lies within
``horizon_seconds`` after it.  Bucket ``b`` then holds exactly the rows with
``ts`` in ``[start(b) - horizon, end(b))`` -- a contiguous slice of the card's
sequence -- and a lag predicate that only accepts predecessors at most
``horizon`` older is evaluated exactly on the rows that are *home* in ``b``.

Rows are copied at most ``1 + ceil(horizon / bucket)`` times; with the
default ``bucket = max(1 day, horizon)`` at most twice, and for a one hour
horizon only the last hour of each day is copied (about 4 %).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X

BUCKET = "_bucket"
HOME = "_home"


def default_bucket(horizon_seconds: int) -> int:
    return max(86400, int(horizon_seconds))


def with_horizon_buckets(
    df: DataFrame,
    ts: str,
    horizon_seconds: int,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Add ``_bucket`` (exploded) and ``_home`` (row belongs to that bucket).

    Every key uses the same bucket width, so the plan is the same at every
    size; a key with a huge share of the rows is spread over its buckets.
    """
    h = int(horizon_seconds)
    size = F.lit(int(bucket_seconds or default_bucket(h)))
    df = df.withColumn("_size", size)
    home = F.floor(X.epoch_seconds(ts) / F.col("_size"))
    reach = F.floor(X.epoch_seconds(F.col(ts) + F.expr(f"INTERVAL '{h}' SECOND")) / F.col("_size"))
    return (
        df.withColumn("_home_bucket", home)
        .withColumn(BUCKET, F.explode(F.sequence(F.col("_home_bucket"), reach)))
        .withColumn(HOME, F.col(BUCKET) == F.col("_home_bucket"))
        .drop("_home_bucket", "_size")
    )


def bucket_window(key: str, ts: str, tiebreak: str) -> Window:
    """Window over one key's bucket, ordered by time then a tie-break column."""
    return Window.partitionBy(key, BUCKET).orderBy(
        F.col(ts).asc_nulls_last(), F.col(tiebreak).asc_nulls_last()
    )


def report_day_bounds(df: DataFrame, ts: str, days, horizon_seconds: int) -> DataFrame:
    """Keep only rows that can matter for report days ``[first, last]``.

    Catalyst does not move a filter below a window, so this is done by hand:
    the earliest useful predecessor is ``horizon`` before the first day.
    """
    if days is None:
        return df
    first, last = days
    lo = F.lit(str(first)).cast("timestamp_ntz") - F.expr(f"INTERVAL '{int(horizon_seconds)}' SECOND")
    hi = F.date_add(F.lit(str(last)).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def in_report_days(ts: str, days):
    if days is None:
        return F.lit(True)
    first, last = days
    return F.to_date(F.col(ts)).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))


def next_in_key(df: DataFrame, keys: list[str], order: list[str], values: list[str], bucket, prefix: str = "_next_") -> DataFrame:
    """For every row, ``values`` of the next row of the same key in ``order``
    (NULL for the key's last row), without one task per key.

    Rows are windowed per (key, bucket) -- ``bucket`` is a column that grows
    with ``order`` (e.g. the day of the start) -- so a key with a huge share
    of the rows is spread over its buckets.  The last row of each bucket takes
    the first row of the key's next non-empty bucket, found on a per-(key,
    bucket) aggregate (map-side partial ``min``) that is tiny next to the
    data.  The result equals ``lead(...) over (partition by key order by
    order)``.
    """
    d = df.withColumn("_nb", bucket)
    w = Window.partitionBy(*keys, "_nb").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    for v in values:
        d = d.withColumn(prefix + v, F.lead(v).over(w))
    d = d.withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]
    firsts = d.groupBy(*keys, "_nb").agg(F.min(F.struct(*fields)).alias("_first"))
    wk = Window.partitionBy(*keys).orderBy("_nb")
    nxt = firsts.select(*keys, "_nb", F.lead("_first").over(wk).alias("_nf"))
    # null-safe: rows without a key are one key, as for a window
    n = nxt.select(*[F.col(c).alias(f"_j_{c}") for c in [*keys, "_nb"]], "_nf")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_j_{c}")) for c in [*keys, "_nb"]])
    d = d.join(n, same, "left").drop(*[f"_j_{c}" for c in [*keys, "_nb"]])
    for i, v in enumerate(values):
        d = d.withColumn(prefix + v, F.when(F.col("_is_last"), F.col(f"_nf._v{i}")).otherwise(F.col(prefix + v)))
    return d.drop("_nb", "_is_last", "_nf")
