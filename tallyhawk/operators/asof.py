"""As-of (validity range) joins against SCD2 history.

Every join here has an equi key, so Spark plans a hash or sort-merge join
with the ``BETWEEN`` as a residual condition; AQE converts it to a broadcast
join at runtime only when the measured dimension side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C


def prefixed(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """Select ``columns`` (default all) renamed with ``prefix``."""
    cols = columns or df.columns
    return df.select([F.col(c).alias(prefix + c) for c in cols])


def live_versions(hist: DataFrame, flag_col: str = C.FLAG_COL) -> DataFrame:
    return hist.filter(X.is_live(flag_col))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    ts: str,
    from_col: str,
    to_col: str,
    grain: str = "ms",
    how: str = "left",
) -> DataFrame:
    """Join each left row to the right version whose [from, to] holds ``ts``.

    Column names of the two sides must be disjoint (use :func:`prefixed`).
    For DATE-grain versions the calendar day of ``ts`` is compared, so an
    operation late on the last valid day still matches (the version is valid
    through that whole day).
    """
    cond = (F.col(left_key) == F.col(right_key)) & X.valid_at(ts, from_col, to_col, grain)
    return left.join(right, cond, how)


def intersect_versions(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_from: str,
    left_to: str,
    right_from: str,
    right_to: str,
    out_from: str,
    out_to: str,
) -> DataFrame:
    """Inner-join two version tables on a key where their intervals overlap.

    The result carries the intersection interval, so a later as-of join on
    the combined table equals the chain of as-of joins (inner semantics).
    Both inputs are dimension-sized; this lets a fact table be joined once
    instead of once per dimension in the chain.
    """
    cond = (
        (F.col(left_key) == F.col(right_key))
        & (F.col(left_from) <= F.col(right_to))
        & (F.col(right_from) <= F.col(left_to))
    )
    joined = left.join(right, cond, "inner")
    return (
        joined.withColumn(out_from, F.greatest(F.col(left_from), F.col(right_from)))
        .withColumn(out_to, F.least(F.col(left_to), F.col(right_to)))
        .drop(left_from, left_to, right_from, right_to)
    )


# The finest timestamp step: gaps between versions are computed with it, so
# they are exact whatever the precision of the probing timestamps.
def _micro():
    return F.expr("INTERVAL '0.000001' SECOND")


def uncovered_parts(
    left: DataFrame,
    right: DataFrame,
    left_ids: list[str],
    left_key: str,
    right_key: str,
    left_from: str,
    left_to: str,
    right_from: str,
    right_to: str,
) -> DataFrame:
    """The parts of each ``left`` interval not covered by any ``right``
    interval of the matching key (timestamp validity, inclusive bounds).

    ``left_ids`` identify a left interval (e.g. key + start).  Right intervals
    of one key must not overlap (an SCD2 invariant).  Returns the left rows
    with ``left_from``/``left_to`` narrowed to each uncovered piece; a left
    interval without any overlapping right interval is returned whole.
    Dimension sized: used to build left-join semantics into a pre-joined
    chain so the fact is joined once.
    """
    r = right.select(F.col(right_key).alias("_rk"), F.col(right_from).alias("_rf"), F.col(right_to).alias("_rt"))
    cond = (F.col(left_key) == F.col("_rk")) & (F.col(left_from) <= F.col("_rt")) & (F.col("_rf") <= F.col(left_to))
    x = left.join(r, cond, "left")
    cf = F.greatest(F.col("_rf"), F.col(left_from))
    ct = F.least(F.col("_rt"), F.col(left_to))
    x = x.withColumn("_cf", cf).withColumn("_ct", ct)
    # the join output is hash partitioned on the key, so a window over
    # (key, interval id) needs no further exchange
    w = Window.partitionBy(left_key, *left_ids).orderBy("_cf")
    x = x.withColumn("_prev_ct", F.lag("_ct").over(w)).withColumn("_next_cf", F.lead("_cf").over(w))
    matched = F.col("_rk").isNotNull()
    piece = lambda frm, to: F.struct(frm.alias("_pf"), to.alias("_pt"))
    pieces = F.array(
        F.when(matched, piece(F.coalesce(F.col("_prev_ct") + _micro(), F.col(left_from)), F.col("_cf") - _micro())),
        F.when(matched & F.col("_next_cf").isNull(), piece(F.col("_ct") + _micro(), F.col(left_to))),
        F.when(~matched, piece(F.col(left_from), F.col(left_to))),
    )
    cols = [c for c in left.columns if c not in (left_from, left_to)]
    out = x.select(*cols, F.explode(F.filter(pieces, lambda p: p.isNotNull() & (p["_pf"] <= p["_pt"]))).alias("_p"))
    return out.select(*cols, F.col("_p._pf").alias(left_from), F.col("_p._pt").alias(left_to))
