"""Append-only fact loads without duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

TX_KEY = ["trans_id", "trans_date"]
TX_COLUMNS = ["trans_id", "trans_date", "amt", "card_num", "oper_type", "oper_result", "terminal"]


def _date(value) -> Column:
    return value if isinstance(value, Column) else X.date_lit(value)


def dedupe_batch(delta: DataFrame, key=TX_KEY, columns=TX_COLUMNS) -> DataFrame:
    """One row per key; among rows sharing a key the smallest image of the
    remaining columns wins (deterministic).  An aggregate, so duplicates are
    combined map-side before the shuffle."""
    rest = [c for c in columns if c not in key]
    agg = delta.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r"))
    return agg.select(*key, *[F.col("_r." + c).alias(c) for c in rest])


def operation_days(df: DataFrame, ts: str = "trans_date") -> list:
    """The calendar days of a delta, ascending: as many values as days."""
    days = df.select(F.to_date(ts).alias("d")).where("d is not null").distinct()
    return sorted(r["d"] for r in days.collect())


def load_transactions(
    existing: DataFrame,
    delta: DataFrame,
    file_date=None,
    prune_existing: bool = True,
    existing_day_col: str | None = None,
    carry=(),
) -> DataFrame:
    """Rows of a daily transaction file to append to the fact.

    * in-file duplicates of (trans_id, trans_date) collapse to one row;
    * a row already in the fact with the same id *and* time is skipped, a
      known id with a new time is a new row;
    * new rows are tagged with ``file_date`` (or keep the delta's own
      ``carry`` columns, e.g. file_date/load_id of a streamed file).

    With ``prune_existing`` the fact is first restricted to the days the file
    has operations of (partition pruning when the fact is partitioned by
    ``existing_day_col``), so the anti join reads these days, not the history,
    also when one of them lies far back.  Without that column the fact is
    pruned to the range of the days.
    """
    cols = TX_COLUMNS + [c for c in carry if c not in TX_COLUMNS]
    batch = dedupe_batch(delta.select(*cols), TX_KEY, cols)
    old = existing.select(*TX_KEY, *([existing_day_col] if existing_day_col else []))
    if prune_existing:
        days = operation_days(batch)
        if not days:
            return batch if file_date is None else batch.withColumn(C.FILE_DATE_COL, _date(file_date))
        if existing_day_col:
            old = old.filter(F.col(existing_day_col).isin(days))
        else:
            old = old.filter(
                (F.col("trans_date") >= F.lit(days[0]).cast("timestamp_ntz"))
                & (F.col("trans_date") < F.date_add(F.lit(days[-1]), 1).cast("timestamp_ntz"))
            )
    new = batch.join(old.select(*TX_KEY), TX_KEY, "left_anti")
    return new if file_date is None else new.withColumn(C.FILE_DATE_COL, _date(file_date))


def slice_accumulating(df: DataFrame, date_col: str, day, since=None) -> DataFrame:
    """Rows of a month-to-date file that belong to ``day`` (or, with
    ``since``, to the days after ``since`` up to ``day``)."""
    d = _date(day)
    if since is None:
        return df.filter(F.col(date_col) == d)
    return df.filter((F.col(date_col) > _date(since)) & (F.col(date_col) <= d))


def load_blacklist(existing: DataFrame, mtd_file: DataFrame, day, run_ts, since=None,
                   date_col: str = "date", passport_col: str = "passport_num") -> DataFrame:
    """Passports of a month-to-date blacklist file to append for ``day``.

    Only the file rows of ``day`` are read (``since`` widens that to missed
    days); passports already in the fact are skipped, so the first listing
    date wins.  Rows are tagged with the load time and the file date.
    """
    rows = slice_accumulating(mtd_file, date_col, day, since).select(
        F.col(date_col).alias("entry_dt"), F.col(passport_col).alias("passport_num")
    )
    first = rows.groupBy("passport_num").agg(F.min("entry_dt").alias("entry_dt"))
    new = first.join(existing.select("passport_num"), "passport_num", "left_anti")
    run = run_ts if isinstance(run_ts, Column) else X.ts_lit(str(run_ts))
    return new.select(
        "entry_dt", "passport_num", run.alias(C.PROCESSED_COL), _date(day).alias(C.FILE_DATE_COL)
    )
