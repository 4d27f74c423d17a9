"""Load state: source watermarks and per-date load/report flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

LOAD_FLAGS = ["transactions_flg", "passport_blacklist_flg", "terminals_flg"]
RULE_FLAGS = ["event_type_1_rep", "event_type_2_rep", "event_type_3_rep", "event_type_4_rep"]
ALL_FLAGS = LOAD_FLAGS + RULE_FLAGS
FILE_KINDS = {"transactions": "transactions_flg", "passport_blacklist": "passport_blacklist_flg", "terminals": "terminals_flg"}


# ------------------------------------------------------------------ watermarks


def incremental_filter(watermark, create_col: str = C.CREATE_COL, update_col: str = C.UPDATE_COL) -> Column:
    """Rows created or updated on/after the watermark's day.

    Written as an OR of plain comparisons so a JDBC scan receives it as a
    pushed filter (a ``coalesce`` would not be pushed).  ``>=`` on the day
    re-reads that day; merges are idempotent, so nothing is lost or doubled.
    """
    w = watermark if isinstance(watermark, Column) else F.lit(str(watermark)).cast("timestamp_ntz")
    day = F.to_date(w).cast("timestamp_ntz")
    u, c = F.col(update_col), F.col(create_col)
    return (u.isNull() & (c >= day)) | (u.isNotNull() & (u >= day))


def incremental_extract(source: DataFrame, watermark, create_col: str = C.CREATE_COL, update_col: str = C.UPDATE_COL) -> DataFrame:
    """Source rows changed since ``watermark`` (``None``: first, full load)."""
    if watermark is None:
        return source
    return source.filter(incremental_filter(watermark, create_col, update_col))


def watermark_lookup(meta: DataFrame, table: str, schema: str = "source"):
    """Stored watermark of one source table, or None before the first load."""
    row = meta.filter((F.col("schema_name") == schema) & (F.col("table_name") == table)).agg(
        F.max("max_update_dt").alias("w")
    ).first()
    return row["w"] if row else None


def extraction_bounds(meta: DataFrame) -> DataFrame:
    """Per source table the first day an incremental read will include."""
    return meta.select("schema_name", "table_name", F.to_date("max_update_dt").alias("extract_from"))


def change_max(changed: DataFrame, table: str, create_col: str = C.CREATE_COL, update_col: str = C.UPDATE_COL) -> DataFrame:
    """Latest change time of a change set (partial aggregate per partition)."""
    return changed.agg(F.max(X.validity_start(update_col, create_col)).alias("_new")).select(
        F.lit(table).alias("table_name"), "_new"
    )


def advance_watermark(meta: DataFrame, changes: dict[str, DataFrame], schema: str = "source",
                      create_col: str = C.CREATE_COL, update_col: str = C.UPDATE_COL) -> DataFrame:
    """New watermark per table = max(old, latest change time of its change set).

    Each table moves independently and never moves back; tables without
    changes keep their watermark; new tables are added.
    """
    news = reduce(lambda a, b: a.unionByName(b), [change_max(df, t, create_col, update_col) for t, df in changes.items()])
    m = meta.filter(F.col("schema_name") == schema).select("table_name", "max_update_dt")
    j = m.join(news, "table_name", "full_outer")
    new = F.when(F.col("max_update_dt").isNull(), F.col("_new")).when(F.col("_new").isNull(), F.col("max_update_dt")).otherwise(
        F.greatest("max_update_dt", "_new")
    )
    others = meta.filter(~F.col("schema_name").eqNullSafe(F.lit(schema))).select("schema_name", "table_name", "max_update_dt")
    return j.select(F.lit(schema).alias("schema_name"), "table_name", new.alias("max_update_dt")).unionByName(others)


# ------------------------------------------------------------------ date points


def date_point_rows(dates: DataFrame, flags: dict[str, int], date_col: str = "date_point") -> DataFrame:
    """One load-state row per date with the given flag values (others 0)."""
    cols = [F.col(date_col).alias("date_point")]
    cols += [F.lit(int(flags.get(f, 0))).alias(f) for f in ALL_FLAGS]
    return dates.select(*cols)


def latest_state(points: DataFrame) -> DataFrame:
    """State per date = every flag's maximum over all appended rows, plus the
    number of rules done.  Appended rows never need to be rewritten."""
    agg = points.groupBy("date_point").agg(*[F.max(f).alias(f) for f in ALL_FLAGS])
    total = reduce(lambda a, b: a + b, [F.col(f) for f in RULE_FLAGS])
    return agg.withColumn("event_type_all_rep", total)


def ready_reports(state: DataFrame, files: DataFrame) -> DataFrame:
    """Which rules can run per date once the available files are loaded.

    ``files``: (date_point, kind) with kind in transactions /
    passport_blacklist / terminals.  Rules 2 and 4 need transactions, rule 1
    also the blacklist, rule 3 also terminals; each runs once per date.
    """
    present = files.groupBy("date_point").agg(
        *[F.max((F.col("kind") == k).cast("int")).alias("_f_" + flag) for k, flag in FILE_KINDS.items()]
    )
    j = state.join(present, "date_point", "full_outer")
    loaded = {f: F.greatest(F.coalesce(F.col(f), F.lit(0)), F.coalesce(F.col("_f_" + f), F.lit(0))) for f in LOAD_FLAGS}
    done = {f: F.coalesce(F.col(f), F.lit(0)) for f in RULE_FLAGS}
    tx_ok = loaded["transactions_flg"] == 1
    return j.select(
        "date_point",
        *[loaded[f].alias(f) for f in LOAD_FLAGS],
        (tx_ok & (loaded["passport_blacklist_flg"] == 1) & (done["event_type_1_rep"] == 0)).alias("run_rule_1"),
        (tx_ok & (done["event_type_2_rep"] == 0)).alias("run_rule_2"),
        (tx_ok & (loaded["terminals_flg"] == 1) & (done["event_type_3_rep"] == 0)).alias("run_rule_3"),
        (tx_ok & (done["event_type_4_rep"] == 0)).alias("run_rule_4"),
    )
