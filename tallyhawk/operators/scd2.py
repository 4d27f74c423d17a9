"""Type-2 slowly changing dimension operators.

History rows carry ``effective_from``, ``effective_to`` (inclusive; the open
version ends at technical infinity) and ``deleted_flg`` ('N' live version,
'Y' delete marker).  ``grain`` is the smallest step of the validity bounds:
'day' for DATE histories filled from daily snapshots, 'ms' for timestamp
histories filled from change sets.

Merges touch only the open versions (at most one per key).  Closed versions
pass through untouched, so the cost of a merge is one shuffle of the open
versions and the staged rows on the business key, independent of how long
the history is.  Keep the history partitioned by openness and feed only the
open part when the history is large (see ``tallyhawk.plans.warehouse``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"
RESTORE = "RESTORE"
KEEP = "KEEP"

ACTION_COL = "change_action"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def scd2_current(hist: DataFrame, grain: str = "ms") -> DataFrame:
    """Open, live versions: the current state of the dimension."""
    return hist.filter(X.is_open(C.TO_COL, grain) & X.is_live(C.FLAG_COL))


def scd2_as_of(hist: DataFrame, ts, grain: str = "ms", include_deleted: bool = False) -> DataFrame:
    """Versions valid at instant ``ts`` (a Column or literal)."""
    t = ts if isinstance(ts, Column) else F.lit(ts)
    if grain == "day":
        t = F.to_date(t)
    cond = t.between(F.col(C.FROM_COL), F.col(C.TO_COL))
    if not include_deleted:
        cond = cond & X.is_live(C.FLAG_COL)
    return hist.filter(cond)


def scd2_close(hist: DataFrame, key, grain: str = "ms", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Recompute every ``effective_to`` as the next version's start minus one
    grain (infinity for the last version of a key).

    Rewrites the whole history of each key; use for backfills and checks.
    Merges close intervals incrementally and give the same result.  The
    "next version" is found per (key, start day) with a hand-over between
    days, so a key with a very long history is not one task.
    """
    from tallyhawk.operators.horizon import next_in_key

    keys = _keys(key)
    order = [C.FROM_COL] + list(tiebreak)
    out = next_in_key(hist, keys, order, [C.FROM_COL], F.to_date(F.col(C.FROM_COL)), prefix="_nx_")
    to = F.coalesce(X.shift(F.col("_nx_" + C.FROM_COL), grain, -1), X.infinity(grain))
    return out.withColumn(C.TO_COL, to).drop("_nx_" + C.FROM_COL).select(*hist.columns, *([] if C.TO_COL in hist.columns else [C.TO_COL]))


def changed(tracked: Sequence[str], old_prefix: str, new_prefix: str) -> Column:
    """Null-safe "any tracked attribute differs" between two prefixed row images."""
    return X.null_safe_changed([(old_prefix + c, new_prefix + c) for c in tracked])


def _merge(
    open_rows: DataFrame,
    keys: list[str],
    tracked: list[str],
    new_from: Column,
    marker_from: Column,
    grain: str,
    extras_new: dict[str, Column],
    with_action: bool,
    live_flag: Column | None,
    src_side: DataFrame,
) -> DataFrame:
    """Shared core: classify every key once, emit replaced + new versions.

    ``src_side`` holds the staged image (``_s_*`` columns, ``_s_present``)
    per key; one full outer join with the open versions classifies each key
    and emits at most two rows for it (the replaced version and the new one).
    """
    o_cols = tracked + [C.FROM_COL, C.TO_COL, C.FLAG_COL] + list(extras_new)
    o = open_rows.select(*keys, *[F.col(c).alias("_o_" + c) for c in o_cols], F.lit(True).alias("_o_present"))
    j = src_side.join(o, keys, "full_outer")

    o_present = F.col("_o_present").isNotNull()
    s_present = F.col("_s_present").isNotNull()
    o_live = F.col("_o_" + C.FLAG_COL) == C.LIVE
    o_deleted = F.col("_o_" + C.FLAG_COL) == C.DELETED
    is_live_key = live_flag if live_flag is not None else s_present
    diff = changed(tracked, "_o_", "_s_")

    action = (
        F.when(o_present & o_live & ~is_live_key, F.lit(DELETE))
        .when(~o_present & s_present, F.lit(INSERT))
        .when(o_present & o_deleted & s_present, F.lit(RESTORE))
        .when(o_present & o_live & s_present & diff, F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    j = j.withColumn("_action", action)

    # Start of the replacing version; never at or before the replaced start.
    guard = lambda start: F.when(o_present, F.greatest(start, X.shift(F.col("_o_" + C.FROM_COL), grain, 1))).otherwise(start)
    j = j.withColumn(
        "_new_from",
        F.when(F.col("_action") == DELETE, guard(marker_from)).otherwise(guard(new_from)),
    )
    replaced = F.col("_action").isin(DELETE, UPDATE, RESTORE)

    def image(prefix_attr: str, from_c: Column, to_c: Column, flag_c: Column, extras: dict[str, Column]) -> Column:
        fields = [F.col(prefix_attr + c).alias(c) for c in tracked]
        fields += [from_c.alias(C.FROM_COL), to_c.alias(C.TO_COL), flag_c.alias(C.FLAG_COL)]
        fields += [v.alias(k) for k, v in extras.items()]
        if with_action:
            fields.append(F.col("_action").alias(ACTION_COL))
        return F.struct(*fields)

    old_image = image(
        "_o_",
        F.col("_o_" + C.FROM_COL),
        F.when(replaced, X.shift(F.col("_new_from"), grain, -1)).otherwise(F.col("_o_" + C.TO_COL)),
        F.col("_o_" + C.FLAG_COL),
        {k: F.col("_o_" + k) for k in extras_new},
    )
    # new version: staged attributes, or the open row's attributes for a marker
    new_attrs_prefix_is_open = F.col("_action") == DELETE
    new_fields = [F.when(new_attrs_prefix_is_open, F.col("_o_" + c)).otherwise(F.col("_s_" + c)).alias(c) for c in tracked]
    new_fields += [
        F.col("_new_from").alias(C.FROM_COL),
        X.infinity(grain).alias(C.TO_COL),
        F.when(new_attrs_prefix_is_open, F.lit(C.DELETED)).otherwise(F.lit(C.LIVE)).alias(C.FLAG_COL),
    ]
    new_fields += [v.alias(k) for k, v in extras_new.items()]
    if with_action:
        new_fields.append(F.col("_action").alias(ACTION_COL))
    new_image = F.struct(*new_fields)

    emits = F.array(
        F.when(o_present, old_image),
        F.when(F.col("_action").isin(INSERT, UPDATE, RESTORE, DELETE), new_image),
    )
    out = j.select(*keys, F.explode(F.filter(emits, lambda x: x.isNotNull())).alias("_v"))
    return out.select(*keys, "_v.*")


def latest_per_key(df: DataFrame, keys: list[str], columns: list[str], order: Column | None = None, order_name: str = "_ord") -> DataFrame:
    """One row per key: the one with the greatest ``order`` (then the greatest
    attribute image, so the choice is deterministic).

    A map-side partial aggregate: repeated keys (a change log, a resent
    snapshot) are combined before the shuffle, and the result is hash
    partitioned on the keys, which the merge's joins reuse.
    """
    fields = ([order.alias(order_name)] if order is not None else []) + [F.col(c).alias(c) for c in columns]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_m"))
    out = [F.col("_m." + c).alias(c) for c in columns]
    if order is not None:
        out.append(F.col("_m." + order_name).alias(order_name))
    return agg.select(*keys, *out)


def _split(hist: DataFrame, grain: str) -> tuple[DataFrame, DataFrame]:
    open_cond = X.is_open(C.TO_COL, grain)
    return hist.filter(open_cond), hist.filter(~open_cond)


def _passthrough(closed: DataFrame, columns: list[str], with_action: bool) -> DataFrame:
    cols = [F.col(c) for c in columns]
    if with_action:
        cols.append(F.lit(None).cast("string").alias(ACTION_COL))
    return closed.select(*cols)


def _start(update_col: str, create_col: str, grain: str) -> Column:
    """Version start on the history's grid: whole milliseconds at ms grain."""
    start = X.validity_start(update_col, create_col)
    return X.trunc_ms(start) if grain == "ms" else start


def scd2_merge_snapshot(
    hist: DataFrame,
    snapshot: DataFrame,
    key,
    tracked: Sequence[str],
    as_of,
    grain: str = "day",
    extras: dict[str, Column] | None = None,
    with_action: bool = False,
) -> DataFrame:
    """Merge a full snapshot taken on ``as_of`` into a history.

    * key not in history (or its open version is a delete marker) -> new version
    * open live version whose tracked attributes differ (null-safe) -> new version
    * open live version missing from the snapshot -> delete marker
    * replaced open versions end one grain before the new start

    Re-merging the same snapshot changes nothing; rows without a key are left
    out.  ``extras`` are literal bookkeeping columns of new rows (e.g.
    ``file_date``); replaced rows keep their own values.
    """
    keys = _keys(key)
    tracked = list(tracked)
    extras = dict(extras or {})
    start = as_of if isinstance(as_of, Column) else (X.date_lit(as_of) if grain == "day" else F.lit(as_of))
    open_rows, closed = _split(hist, grain)
    snap = latest_per_key(snapshot.dropna(subset=keys), keys, tracked)
    s = snap.select(*keys, *[F.col(c).alias("_s_" + c) for c in tracked], F.lit(True).alias("_s_present"))
    merged = _merge(open_rows, keys, tracked, start, start, grain, extras, with_action, None, s)
    columns = keys + tracked + [C.FROM_COL, C.TO_COL, C.FLAG_COL] + list(extras)
    return merged.unionByName(_passthrough(closed, columns, with_action))


def scd2_insert_snapshot(
    hist: DataFrame, snapshot: DataFrame, key, tracked: Sequence[str], as_of, next_as_of=None, file_date_col: str | None = C.FILE_DATE_COL
) -> DataFrame:
    """The DATE-grain history as it would be had the snapshot of ``as_of`` been
    merged in its turn, though later ones, the next on ``next_as_of``, already
    are (a snapshot of that day merged before is replaced).

    Each key's history is a row of points (day, state).  Those between the two
    days go; the snapshot's state is put at ``as_of`` and what the history
    says of ``next_as_of`` is put there; points that change nothing are
    dropped, and the versions are read off the rest.
    """
    keys, tracked = _keys(key), list(tracked)
    day = X.date_lit(as_of)
    state = F.struct(*tracked)

    def points(df, at, live, attrs):
        return df.select(*keys, at.alias("at"), live.alias("live"), attrs.alias("attrs"))

    live_row = F.col(C.FLAG_COL) == C.LIVE
    kept = F.col(C.FROM_COL) < day
    if next_as_of is not None:
        kept |= F.col(C.FROM_COL) >= X.date_lit(next_as_of)
    parts = [points(hist.where(kept), F.col(C.FROM_COL), live_row, state)]
    snap = latest_per_key(snapshot.dropna(subset=keys), keys, tracked).select(*keys, state.alias("attrs"))
    every = hist.select(*keys).union(snap.select(*keys)).distinct()
    then = every.join(snap, keys, "left")
    parts.append(points(then, day, F.col("attrs").isNotNull(), F.col("attrs")))
    if next_as_of is not None:
        on_next = X.date_lit(next_as_of)
        valid = hist.where(X.valid_at(on_next, C.FROM_COL, C.TO_COL, grain="day"))
        later = every.join(valid.select(*keys, F.col(C.FROM_COL).alias("_f"), live_row.alias("live"), state.alias("attrs")), keys, "left")
        later = later.where(~F.col("_f").eqNullSafe(on_next))  # else it is a point already
        parts.append(points(later, on_next, F.coalesce("live", F.lit(False)), F.col("attrs")))
    by_day = Window.partitionBy(*keys).orderBy("at")
    told = parts[0]
    for p in parts[1:]:
        told = told.unionByName(p)
    told = told.select("*", F.lag("live").over(by_day).alias("was"), F.lag("attrs").over(by_day).alias("had"))
    same = F.when(F.col("live"), F.coalesce("was", F.lit(False)) & F.col("attrs").eqNullSafe(F.col("had"))).otherwise(
        ~F.coalesce("was", F.lit(False))
    )
    told = told.where(~same)
    told = told.select("*", F.lag("attrs").over(by_day).alias("before"), F.lead("at").over(by_day).alias("next"))
    attrs = F.when(F.col("live"), F.col("attrs")).otherwise(F.col("before"))
    told = told.withColumn("a", attrs)
    out = [*keys, *[F.col(f"a.{c}").alias(c) for c in tracked], F.col("at").alias(C.FROM_COL)]
    out.append(F.coalesce(F.date_sub("next", 1), X.infinity("day")).alias(C.TO_COL))
    out.append(F.when(F.col("live"), C.LIVE).otherwise(C.DELETED).alias(C.FLAG_COL))
    if file_date_col:
        out.append(F.col("at").alias(file_date_col))
    return told.select(*out)


def scd2_merge_incremental(
    hist: DataFrame,
    changed_rows: DataFrame,
    live_keys: DataFrame,
    key,
    tracked: Sequence[str],
    run_ts,
    grain: str = "ms",
    create_col: str = C.CREATE_COL,
    update_col: str = C.UPDATE_COL,
    processed_col: str | None = C.PROCESSED_COL,
    with_action: bool = False,
) -> DataFrame:
    """Merge a change set of a current-state (SCD1) source into a history.

    ``changed_rows`` are the source rows changed since the last watermark
    (key, tracked attributes, create/update time; several rows per key are
    allowed, the latest wins); ``live_keys`` is the full key list of the
    source, used to detect deletions.  Changed rows whose key
    is no longer live are ignored, so a key deleted between the two reads
    only gets its delete marker.

    New versions start at ``coalesce(update, create)``; delete markers at
    ``run_ts``; any start is pushed past the replaced version's start so no
    interval can invert.  ``processed_col`` (if set) records ``run_ts`` on
    new rows.
    """
    keys = _keys(key)
    tracked = list(tracked)
    run = run_ts if isinstance(run_ts, Column) else X.ts_lit(str(run_ts))
    extras = {processed_col: run} if processed_col else {}
    open_rows, closed = _split(hist, grain)
    live = live_keys.select(*keys).dropna().distinct().withColumn("_live", F.lit(True))
    # the latest change per key (a change set may hold several per key)
    latest = latest_per_key(changed_rows, keys, tracked, _start(update_col, create_col, grain), "_start")
    staged = latest.select(
        *keys,
        *[F.col(c).alias("_s_" + c) for c in tracked],
        F.col("_start").alias("_s_start"),
        F.lit(True).alias("_s_present"),
    )
    # live keys LEFT staged: staged rows of keys that vanished are dropped;
    # both sides shuffle on the key, the full outer join below reuses it.
    src = live.join(staged, keys, "left")
    merged = _merge(
        open_rows, keys, tracked, F.col("_s_start"), run, grain, extras, with_action,
        F.col("_live").isNotNull(), src,
    )
    columns = keys + tracked + [C.FROM_COL, C.TO_COL, C.FLAG_COL] + list(extras)
    return merged.unionByName(_passthrough(closed, columns, with_action))


def scd2_initial(rows: DataFrame, key, tracked: Sequence[str], run_ts, grain: str = "ms",
                 create_col: str = C.CREATE_COL, update_col: str = C.UPDATE_COL,
                 processed_col: str | None = C.PROCESSED_COL, live_keys: DataFrame | None = None) -> DataFrame:
    """First load of a history from a source: one open live version per key,
    from its latest row (rows without a key are left out).  ``live_keys``, if
    given, are the keys the source still has: others are left out as well."""
    keys = _keys(key)
    rows = latest_per_key(rows.dropna(subset=keys), keys, [*tracked, create_col, update_col], _start(update_col, create_col, grain))
    if live_keys is not None:
        rows = rows.join(live_keys.select(*keys), keys, "left_semi")
    run = run_ts if isinstance(run_ts, Column) else X.ts_lit(str(run_ts))
    cols = [F.col(k) for k in keys] + [F.col(c) for c in tracked]
    cols += [_start(update_col, create_col, grain).alias(C.FROM_COL), X.infinity(grain).alias(C.TO_COL), F.lit(C.LIVE).alias(C.FLAG_COL)]
    if processed_col:
        cols.append(run.alias(processed_col))
    return rows.select(*cols)


def empty_history(spark, key_types: dict[str, str], tracked_types: dict[str, str], grain: str = "ms",
                  extras: dict[str, str] | None = None):
    """An empty history with the given column types."""
    t = "date" if grain == "day" else "timestamp_ntz"
    fields = [f"{k} {v}" for k, v in {**key_types, **tracked_types}.items()]
    fields += [f"{C.FROM_COL} {t}", f"{C.TO_COL} {t}", f"{C.FLAG_COL} string"]
    fields += [f"{k} {v}" for k, v in (extras or {}).items()]
    return spark.createDataFrame([], ", ".join(fields))


def classify_changes(old: DataFrame, new: DataFrame, key, tracked: Sequence[str]) -> DataFrame:
    """Per key: INSERT (only new), DELETE (only old), UPDATE (tracked attributes
    differ, null-safe) or KEEP, from one full outer join (repeated keys are
    collapsed map-side first)."""
    keys = _keys(key)
    tracked = list(tracked)
    o = latest_per_key(old, keys, tracked).select(*keys, *[F.col(c).alias("_o_" + c) for c in tracked], F.lit(True).alias("_o"))
    n = latest_per_key(new, keys, tracked).select(*keys, *[F.col(c).alias("_s_" + c) for c in tracked], F.lit(True).alias("_n"))
    j = o.join(n, keys, "full_outer")
    act = (
        F.when(F.col("_o").isNull(), F.lit(INSERT))
        .when(F.col("_n").isNull(), F.lit(DELETE))
        .when(changed(tracked, "_o_", "_s_"), F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    return j.select(*keys, act.alias(ACTION_COL))
