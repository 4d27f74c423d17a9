"""Per-key sequences cut by row count instead of by time.

Rows are range partitioned on (key, order), so every part holds about the
same number of rows however dense a key is: a card with all its operations in
one day is spread like any other.  What a part needs from before its first row
is handed to it: only keys that straddle a boundary have anything to hand
over, at most ``depth`` rows a part, so the hand-over grows with the number of
parts and not with the data.

The parts are checkpointed once (range boundaries are sampled anew by every
plan that computes them, and two branches of a job must see the same ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.session import cut

PART = "_part"


def in_ranges(df: DataFrame, key: str, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with ``_part``: contiguous ranges of (key, order) of about the
    same number of rows, ``spark.sql.shuffle.partitions`` of them by default.
    Rows equal in key and order share a part."""
    n = int(parts or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_last() for c in [key, *order]]
    return cut(df.repartitionByRange(n, *by).withColumn(PART, F.spark_partition_id()))


def _straddling(ranged: DataFrame, key: str) -> DataFrame:
    """Rows of the first and the last key of every part: no other key can
    have rows in a second part.  Two keys a part are looked up."""
    edges = ranged.groupBy(PART).agg(F.min(key).alias("_first_key"), F.max(key).alias("_last_key"))
    near = ranged.join(edges, PART).where((F.col(key) == F.col("_first_key")) | (F.col(key) == F.col("_last_key")))
    return near.drop("_first_key", "_last_key")


def with_previous(df: DataFrame, key: str, order: list[str], values: list[str], depth: int = 1, parts: int | None = None) -> DataFrame:
    """``df`` with ``_prev<k>_<value>`` for k = 1..depth: the value in the
    k-th row before, of the same key in ``order`` (null where there is none),
    equal to ``lag(value, k) over (partition by key order by order)``.

    ``order`` must be total within a key for a defined result, nulls sort
    last.  Rows without a key are no sequence: their previous values are null.
    """
    names = {(v, k): f"_prev{k}_{v}" for k in range(1, depth + 1) for v in values}
    types = {f.name: f.dataType for f in df.schema.fields}
    ranged = in_ranges(df.where(F.col(key).isNotNull()), key, order, parts)
    by = [F.col(c).asc_nulls_last() for c in order]

    # the last rows of a straddling key in each part, in order, as one array
    last = Window.partitionBy(PART, key).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    ends = _straddling(ranged, key).withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= depth)
    fields = [F.col(c) for c in dict.fromkeys([*order, *values])]
    ends = ends.groupBy(key, PART).agg(F.sort_array(F.collect_list(F.struct((-F.col("_n")).alias("_back"), *fields))).alias("_ends"))
    # the parts of the key before this one hold a row each at least
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(-depth, -1)
    handed = ends.select(key, PART, F.flatten(F.collect_list("_ends").over(before)).alias("_ends"))
    handed = handed.select(key, PART, F.explode(F.slice(F.reverse("_ends"), 1, depth)).alias("_e"))
    handed = handed.select(key, PART, "_e.*").drop("_back")

    here = ranged.withColumn("_home", F.lit(True))
    stream = here.unionByName(handed.withColumn("_home", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(PART, key).orderBy(*by)
    for (v, k), name in names.items():
        stream = stream.withColumn(name, F.lag(v, k).over(w))
    out = stream.where("_home").select(*df.columns, *names.values())
    unkeyed = df.where(F.col(key).isNull())
    for (v, _), name in names.items():
        unkeyed = unkeyed.withColumn(name, F.lit(None).cast(types[v]))
    return out.unionByName(unkeyed)


def _instant(ts: str, grain: str) -> Column:
    return F.to_date(F.col(ts)) if grain == "day" else F.col(ts)


def asof_carried(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    ts: str,
    from_col: str,
    to_col: str,
    grain: str = "ms",
    how: str = "left",
    parts: int | None = None,
) -> DataFrame:
    """:func:`tallyhawk.operators.asof.asof_join` in linear time.

    Versions and operations are one stream sorted by (key, time); the last
    version is carried forward to the operations after it and kept where its
    end is not passed.  No (operation, version) pair is formed, so a busy key
    with a long history costs its operations plus its versions, not their
    product.  Versions of a key must not overlap (an SCD2 invariant; of
    overlapping ones the last started counts).  Column names of the two sides
    must be disjoint; the keys must have one type.  Operations without a key
    or a time, and versions without a key or a start, match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    version = F.struct(*[F.col(c) for c in right.columns])
    operation = F.struct(*[F.col(c) for c in left.columns])
    known = F.col(left_key).isNotNull() & F.col(ts).isNotNull()
    # operations at one instant are told apart by a hash, so that a great
    # number of them is spread too; versions come before them
    ops = left.where(known).select(
        F.col(left_key).alias("_k"), _instant(ts, grain).alias("_t"), F.lit(1).alias("_kind"),
        F.xxhash64(*[F.col(c) for c in left.columns]).alias("_tie"), operation.alias("_op"),
    )
    vers = right.where(F.col(right_key).isNotNull() & F.col(from_col).isNotNull()).select(
        F.col(right_key).alias("_k"), F.col(from_col).alias("_t"), F.lit(0).alias("_kind"),
        F.lit(0).cast("bigint").alias("_tie"), version.alias("_ver"),
    )
    order = ["_t", "_kind", "_tie"]
    ranged = in_ranges(vers.unionByName(ops, allowMissingColumns=True), "_k", order, parts)

    # the last version of a straddling key in each part, then the last one of
    # all parts before: put at the head of the part as one more version
    ends = _straddling(ranged, "_k").groupBy("_k", PART).agg(
        F.max(F.when(F.col("_kind") == 0, F.col("_t"))).alias("_t"),
        F.max_by("_ver", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_ver"),
    )
    before = Window.partitionBy("_k").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(
        "_k", PART,
        F.last("_t", ignorenulls=True).over(before).alias("_t"),
        F.last("_ver", ignorenulls=True).over(before).alias("_ver"),
    ).where(F.col("_t").isNotNull())
    handed = handed.withColumn("_kind", F.lit(0)).withColumn("_tie", F.lit(0).cast("bigint"))

    w = Window.partitionBy(PART, "_k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = ranged.unionByName(handed, allowMissingColumns=True).withColumn("_last", F.last("_ver", ignorenulls=True).over(w))
    valid = X.valid_at("_t", F.col(f"_last.{from_col}"), F.col(f"_last.{to_col}"))
    carried = carried.where("_kind = 1").withColumn("_hit", F.when(valid, F.col("_last")))
    if how == "inner":
        carried = carried.where(F.col("_hit").isNotNull())
    out = carried.select("_op.*", *[F.col(f"_hit.{c}").alias(c) for c in right.columns])
    if how == "inner":
        return out
    rest = left.where(~known)
    for f in right.schema.fields:
        rest = rest.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out.unionByName(rest)
