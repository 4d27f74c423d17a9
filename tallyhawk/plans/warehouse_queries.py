"""Registered warehouse-maintenance queries: SCD2 merges and interval closing,
key comparisons, fact loads, watermarks, load state and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C
from tallyhawk.operators import facts as L
from tallyhawk.operators import quality as Q
from tallyhawk.operators import scd2 as S
from tallyhawk.operators import state as ST
from tallyhawk.plans import views as V
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.plans.registry import register
from tallyhawk.sources import files as FS

# --------------------------------------------------------------------------
# SCD2: snapshot merges of terminals (DATE grain)

D1, D2, D3 = "2024-01-10", "2024-01-20", "2024-01-25"
TERMINAL_TRACKED = ["terminal_type", "terminal_city", "terminal_address"]


def terminal_history(spark: SparkSession, d: str, steps) -> DataFrame:
    hist = S.empty_history(
        spark, {"terminal_id": "string"}, {c: "string" for c in TERMINAL_TRACKED}, grain="day",
        extras={C.FILE_DATE_COL: "date"},
    )
    for which, day in steps:
        hist = S.scd2_merge_snapshot(
            hist, V.terminal_snapshot(spark, d, which), "terminal_id", TERMINAL_TRACKED, day,
            grain="day", extras={C.FILE_DATE_COL: X.date_lit(day)},
        )
    return hist


_T_COLS = "{a}.terminal_id, {a}.terminal_type, {a}.terminal_city, {a}.terminal_address"
_T_SAME = (
    "a.terminal_type IS NOT DISTINCT FROM b.terminal_type AND a.terminal_city IS NOT DISTINCT FROM b.terminal_city "
    "AND a.terminal_address IS NOT DISTINCT FROM b.terminal_address"
)


def _trow(alias: str, frm: str, to: str, flag: str, file_date: str) -> str:
    return f"SELECT {_T_COLS.format(a=alias)}, {frm} AS effective_from, {to} AS effective_to, '{flag}' AS deleted_flg, {file_date} AS file_date"


_INF = "DATE '9999-12-31'"
_d = lambda s: f"DATE '{s}'"
_dm1 = lambda s: f"(DATE '{s}' - 1)"
_AB = " FROM terminals_a a JOIN terminals_b b ON a.terminal_id = b.terminal_id"
_A_ONLY = " FROM terminals_a a WHERE NOT EXISTS (SELECT 1 FROM terminals_b b WHERE b.terminal_id = a.terminal_id)"
_B_ONLY = " FROM terminals_b b WHERE NOT EXISTS (SELECT 1 FROM terminals_a a WHERE a.terminal_id = b.terminal_id)"

SNAPSHOT_INSERT_SQL = with_views(_trow("a", _d(D1), _INF, "N", _d(D1)) + " FROM terminals_a a")

SNAPSHOT_MERGE_SQL = with_views(
    " UNION ALL ".join(
        [
            _trow("a", _d(D1), _INF, "N", _d(D1)) + _AB + f" WHERE {_T_SAME}",
            _trow("a", _d(D1), _dm1(D2), "N", _d(D1)) + _AB + f" WHERE NOT ({_T_SAME})",
            _trow("b", _d(D2), _INF, "N", _d(D2)) + _AB + f" WHERE NOT ({_T_SAME})",
            _trow("a", _d(D1), _dm1(D2), "N", _d(D1)) + _A_ONLY,
            _trow("a", _d(D2), _INF, "Y", _d(D2)) + _A_ONLY,
            _trow("b", _d(D2), _INF, "N", _d(D2)) + _B_ONLY,
        ]
    )
)

RESTORE_SQL = with_views(
    " UNION ALL ".join(
        [
            _trow("a", _d(D1), _INF, "N", _d(D1)) + _AB + f" WHERE {_T_SAME}",
            _trow("a", _d(D1), _dm1(D2), "N", _d(D1)) + _AB + f" WHERE NOT ({_T_SAME})",
            _trow("b", _d(D2), _dm1(D3), "N", _d(D2)) + _AB + f" WHERE NOT ({_T_SAME})",
            _trow("a", _d(D3), _INF, "N", _d(D3)) + _AB + f" WHERE NOT ({_T_SAME})",
            _trow("a", _d(D1), _dm1(D2), "N", _d(D1)) + _A_ONLY,
            _trow("a", _d(D2), _dm1(D3), "Y", _d(D2)) + _A_ONLY,
            _trow("a", _d(D3), _INF, "N", _d(D3)) + _A_ONLY,
            _trow("b", _d(D2), _dm1(D3), "N", _d(D2)) + _B_ONLY,
            _trow("b", _d(D3), _INF, "Y", _d(D3)) + _B_ONLY,
        ]
    )
)


@register("scd2_snapshot_insert", SNAPSHOT_INSERT_SQL)
def scd2_snapshot_insert(spark, d):
    """M-2, insert path: first snapshot into an empty history."""
    return terminal_history(spark, d, [("a", D1)])


@register("scd2_snapshot_merge", SNAPSHOT_MERGE_SQL)
def scd2_snapshot_merge(spark, d):
    """M-2: inserts, updates, delete markers and interval closing from a second snapshot."""
    return terminal_history(spark, d, [("a", D1), ("b", D2)])


@register("scd2_restore", RESTORE_SQL)
def scd2_restore(spark, d):
    """M-2 / J-3: a third snapshot restores deleted keys and reverts changes."""
    return terminal_history(spark, d, [("a", D1), ("b", D2), ("a", D3)])


# --------------------------------------------------------------------------
# Output convention for timestamp histories: an open version is shown with
# effective_to NULL and is_open = true (technical infinity 9999-12-31 is kept
# inside the library; it is outside the nanosecond range of pandas, which
# result consumers often convert to).


def open_as_null(df: DataFrame) -> DataFrame:
    is_open = F.col(C.TO_COL) == X.inf_ts()
    return df.withColumn("is_open", is_open).withColumn(C.TO_COL, F.when(is_open, F.lit(None)).otherwise(F.col(C.TO_COL)))


def open_as_null_sql(body: str) -> str:
    return (
        "SELECT * REPLACE (NULLIF(effective_to, TIMESTAMP '9999-12-31 00:00:00') AS effective_to), "
        f"effective_to = TIMESTAMP '9999-12-31 00:00:00' AS is_open FROM ({body}) q"
    )


# --------------------------------------------------------------------------
# SCD2: incremental merges of a changing source (timestamp grain, 1 ms)

R1, R2 = "1998-01-01 00:00:00", "2002-01-01 00:00:00"
STATUS_TRACKED = ["priority", "status"]


def status_source(spark: SparkSession, d: str, run: int) -> DataFrame:
    """Current state of the status source at run 1 (year a) or run 2 (year b)."""
    a = V.status(spark, d, "a")
    if run == 1:
        return a.select("cust_key", *STATUS_TRACKED, F.col("changed_at").alias(C.CREATE_COL), F.lit(None).cast("timestamp_ntz").alias(C.UPDATE_COL))
    b = V.status(spark, d, "b")
    j = b.join(a.select("cust_key", F.col("changed_at").alias("_a_changed")), "cust_key", "left")
    return j.select(
        "cust_key", *STATUS_TRACKED,
        F.coalesce("_a_changed", "changed_at").alias(C.CREATE_COL),
        F.when(F.col("_a_changed").isNotNull(), F.col("changed_at")).alias(C.UPDATE_COL),
    )


def _no_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "schema_name string, table_name string, max_update_dt timestamp_ntz")


def status_history(spark: SparkSession, d: str, runs: int, with_action: bool = False) -> DataFrame:
    hist = S.empty_history(spark, {"cust_key": "bigint"}, {"priority": "string", "status": "string"}, grain="ms",
                           extras={C.PROCESSED_COL: "timestamp_ntz"})
    watermark = None
    for run, run_ts in list(enumerate([R1, R2], start=1))[:runs]:
        src = status_source(spark, d, run)
        changed = ST.incremental_extract(src, watermark)
        last = run == runs
        hist = S.scd2_merge_incremental(hist, changed, src.select("cust_key"), "cust_key", STATUS_TRACKED, run_ts,
                                        with_action=with_action and last)
        if not last:  # the next run reads changes since this one
            watermark = ST.watermark_lookup(ST.advance_watermark(_no_meta(spark), {"status": changed}), "status")
    return hist


_S_COLS = "{a}.cust_key, {a}.priority, {a}.status"
_S_SAME = "a.priority IS NOT DISTINCT FROM b.priority AND a.status IS NOT DISTINCT FROM b.status"
_TS_INF = "TIMESTAMP '9999-12-31 00:00:00'"
_r = lambda s: f"TIMESTAMP '{s}'"


def _srow(alias: str, frm: str, to: str, flag: str, processed: str) -> str:
    return (
        f"SELECT {_S_COLS.format(a=alias)}, {frm} AS effective_from, {to} AS effective_to, "
        f"'{flag}' AS deleted_flg, {processed} AS processed_dt"
    )


_SAB = " FROM status_a a JOIN status_b b ON a.cust_key = b.cust_key"
_SA_ONLY = " FROM status_a a WHERE NOT EXISTS (SELECT 1 FROM status_b b WHERE b.cust_key = a.cust_key)"
_SB_ONLY = " FROM status_b b WHERE NOT EXISTS (SELECT 1 FROM status_a a WHERE a.cust_key = b.cust_key)"

INC_KEEP = [_srow("a", "a.changed_at", _TS_INF, "N", _r(R1)) + _SAB + f" WHERE {_S_SAME}"]
INC_UPDATE = [
    _srow("a", "a.changed_at", "b.changed_at - INTERVAL 1 MILLISECOND", "N", _r(R1)) + _SAB + f" WHERE NOT ({_S_SAME})",
    _srow("b", "b.changed_at", _TS_INF, "N", _r(R2)) + _SAB + f" WHERE NOT ({_S_SAME})",
]
INC_DELETE = [
    _srow("a", "a.changed_at", f"{_r(R2)} - INTERVAL 1 MILLISECOND", "N", _r(R1)) + _SA_ONLY,
    _srow("a", _r(R2), _TS_INF, "Y", _r(R2)) + _SA_ONLY,
]
INC_INSERT = [_srow("b", "b.changed_at", _TS_INF, "N", _r(R2)) + _SB_ONLY]


@register("scd2_incremental_insert", with_views(open_as_null_sql(_srow("a", "a.changed_at", _TS_INF, "N", _r(R1)) + " FROM status_a a")))
def scd2_incremental_insert(spark, d):
    """M-1, first run: every source row becomes an open version starting at its creation."""
    return open_as_null(status_history(spark, d, 1))


def _with_action(spark, d, action):
    h = status_history(spark, d, 2, with_action=True)
    return open_as_null(h.filter(F.col(S.ACTION_COL) == action).drop(S.ACTION_COL))


@register("scd2_incremental_update", with_views(open_as_null_sql(" UNION ALL ".join(INC_UPDATE))))
def scd2_incremental_update(spark, d):
    """M-1, second run: versions of keys whose tracked attributes changed (null-safe)."""
    return _with_action(spark, d, S.UPDATE)


@register("scd2_incremental_delete", with_views(open_as_null_sql(" UNION ALL ".join(INC_DELETE))))
def scd2_incremental_delete(spark, d):
    """M-1, second run: keys gone from the source get a delete marker at the run time."""
    return _with_action(spark, d, S.DELETE)


@register("scd2_incremental_merge", with_views(open_as_null_sql(" UNION ALL ".join(INC_KEEP + INC_UPDATE + INC_DELETE + INC_INSERT))))
def scd2_incremental_merge(spark, d):
    """M-1: the whole history after two incremental runs."""
    return open_as_null(status_history(spark, d, 2))


# --------------------------------------------------------------------------
# interval closing, change detection, key comparisons


@register(
    "scd2_close_intervals",
    with_views(open_as_null_sql(
        "SELECT cust_key, order_key, effective_from, COALESCE(lead(effective_from) OVER "
        "(PARTITION BY cust_key ORDER BY effective_from, order_key) - INTERVAL 1 MILLISECOND, "
        f"{_TS_INF}) AS effective_to FROM versions"
    )),
)
def scd2_close_intervals(spark, d):
    """W-1 / J-9: each version ends 1 ms before the next one of its key."""
    v = V.versions(spark, d).select("cust_key", "order_key", C.FROM_COL)
    return open_as_null(S.scd2_close(v, "cust_key", grain="ms", tiebreak=["order_key"]))


@register(
    "scd2_close_dates",
    with_views(
        "SELECT cust_key, order_key, CAST(effective_from AS DATE) AS effective_from, "
        "COALESCE(lead(CAST(effective_from AS DATE)) OVER (PARTITION BY cust_key ORDER BY effective_from, order_key) - 1, "
        f"{_INF}) AS effective_to FROM versions"
    ),
)
def scd2_close_dates(spark, d):
    """W-2: DATE-grain versions end the day before the next one."""
    v = V.versions(spark, d).select("cust_key", "order_key", F.to_date(C.FROM_COL).alias(C.FROM_COL))
    return S.scd2_close(v, "cust_key", grain="day", tiebreak=["order_key"])


@register(
    "changed_rows_null_safe",
    with_views(
        "SELECT a.cust_key, a.priority AS old_priority, b.priority AS new_priority, a.status AS old_status, "
        "b.status AS new_status FROM status_a a JOIN status_b b ON a.cust_key = b.cust_key "
        "WHERE a.priority IS DISTINCT FROM b.priority OR a.status IS DISTINCT FROM b.status"
    ),
)
def changed_rows_null_safe(spark, d):
    """P-4 / J-4: keys present in both states whose tracked attributes differ (NULL = NULL)."""
    a = V.status(spark, d, "a").select("cust_key", *[F.col(c).alias("old_" + c) for c in STATUS_TRACKED])
    b = V.status(spark, d, "b").select("cust_key", *[F.col(c).alias("new_" + c) for c in STATUS_TRACKED])
    j = a.join(b, "cust_key", "inner")
    return j.filter(S.changed(STATUS_TRACKED, "old_", "new_")).select(
        "cust_key", "old_priority", "new_priority", "old_status", "new_status"
    )


@register("new_keys_anti", with_views("SELECT b.cust_key, b.priority" + _SB_ONLY))
def new_keys_anti(spark, d):
    """J-1: keys of the new state that the old one lacks."""
    b = V.status(spark, d, "b")
    return b.join(V.status(spark, d, "a").select("cust_key"), "cust_key", "left_anti").select("cust_key", "priority")


@register(
    "deleted_keys_anti",
    with_views("SELECT a.cust_key, a.priority" + _SA_ONLY),
)
def deleted_keys_anti(spark, d):
    """J-2: keys of the old state missing from the new one (delete detection)."""
    a = V.status(spark, d, "a")
    return a.join(V.status(spark, d, "b").select("cust_key"), "cust_key", "left_anti").select("cust_key", "priority")


@register(
    "in_subquery_semi",
    with_views("SELECT cust_key, priority, status FROM status_a WHERE cust_key IN (SELECT cust_key FROM status_b)"),
)
def in_subquery_semi(spark, d):
    """J-8: rows whose key occurs in another relation (semi join)."""
    a = V.status(spark, d, "a")
    return a.join(V.status(spark, d, "b").select("cust_key"), "cust_key", "left_semi").select("cust_key", "priority", "status")


@register(
    "null_validity_sentinel",
    with_views("SELECT client_id, COALESCE(passport_valid_to, DATE '9999-12-31') AS passport_valid_to FROM clients_src"),
)
def null_validity_sentinel(spark, d):
    """P-10: a passport without end date is valid until technical infinity."""
    from tallyhawk.plans.warehouse import stage_clients

    return stage_clients(V.clients_src(spark, d)).select("client_id", "passport_valid_to")


@register(
    "stage_clients_source",
    with_views(
        "SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num,"
        " COALESCE(passport_valid_to, DATE '9999-12-31') AS passport_valid_to, phone, create_dt, update_dt FROM clients_src"
    ),
)
def stage_clients_source(spark, d):
    """P-1: blank-padded source rows staged under warehouse names."""
    from tallyhawk.plans.warehouse import stage_source

    src = V.clients_src(spark, d)
    padded = [F.rpad(c, n, " ").alias(c) if c in ("client_id", "phone") else F.col(c)
              for c, n in ((c, C.STRING_LIMITS.get(c)) for c in src.columns)]
    return stage_source(src.select(*padded), "clients")


# --------------------------------------------------------------------------
# fact loads

_CSV = {"sep": ";"}


@register(
    "read_transaction_lines",
    with_views(
        "SELECT trans_id, date_trunc('milliseconds', trans_date) AS trans_date, amt, card_num, oper_type, oper_result, terminal FROM tx"
    ),
)
def read_transaction_lines(spark, d):
    """S-1: transaction file lines (decimal comma, padded card) parsed and normalised."""
    tx = V.tx(spark, d)
    line = F.to_csv(
        F.struct(
            "trans_id", F.date_format("trans_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("trans_date"),
            F.translate(F.col("amt").cast("string"), ".", ",").alias("amt"),
            F.rpad("card_num", C.STRING_LIMITS["card_num"], " ").alias("card_num"),
            "oper_type", "oper_result", "terminal",
        ),
        {**_CSV, "ignoreTrailingWhiteSpace": "false"},
    )
    fields = F.from_csv(line, FS.TRANSACTION_CSV_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " "), _CSV)
    return FS.normalize_transactions(tx.select(fields.alias("f")).select("f.*"))

LOAD_FILE_DATE = "2024-01-31"
EXISTING_BEFORE = "2024-01-16 00:00:00"
DELTA_FROM = "2024-01-15 00:00:00"
RESENT_DAY = "2024-01-20"

LOAD_TX_SQL = with_views(
    "SELECT trans_id, trans_date, amt, card_num, oper_type, oper_result, terminal, "
    f"DATE '{LOAD_FILE_DATE}' AS file_date FROM (SELECT DISTINCT * FROM delta) d "
    "WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.trans_id = d.trans_id AND e.trans_date = d.trans_date)",
    [
        ("delta", f"SELECT * FROM tx WHERE trans_date >= TIMESTAMP '{DELTA_FROM}' "
                  f"UNION ALL SELECT * FROM tx WHERE CAST(trans_date AS DATE) = DATE '{RESENT_DAY}'"),
        ("existing", f"SELECT * FROM tx WHERE trans_date < TIMESTAMP '{EXISTING_BEFORE}'"),
    ],
)


@register("load_transactions", LOAD_TX_SQL)
def load_transactions(spark, d):
    """L-1 / J-10 / K-5: new rows of an overlapping, partly re-sent delta, tagged with the file date."""
    tx = V.tx(spark, d)
    existing = tx.filter(F.col("trans_date") < X.ts_lit(EXISTING_BEFORE))
    delta = tx.filter(F.col("trans_date") >= X.ts_lit(DELTA_FROM)).unionByName(
        tx.filter(F.to_date("trans_date") == X.date_lit(RESENT_DAY))
    )
    return L.load_transactions(existing, delta, LOAD_FILE_DATE)


BL_DAY = "2024-01-20"
BL_RELIST_UNTIL = "2024-01-05"
BL_RUN_TS = "2024-01-20 06:00:00"


def blacklist_mtd_file(spark: SparkSession, d: str) -> DataFrame:
    """Month-to-date blacklist file of BL_DAY: every listing so far, plus early
    passports listed once more on that day."""
    b = V.blacklist(spark, d)
    rows = b.filter(F.col("entry_dt") <= X.date_lit(BL_DAY)).select(F.col("entry_dt").alias("date"), "passport_num")
    relisted = b.filter(F.col("entry_dt") <= X.date_lit(BL_RELIST_UNTIL)).select(X.date_lit(BL_DAY).alias("date"), "passport_num")
    return rows.unionByName(relisted)


@register(
    "load_blacklist",
    with_views(
        f"SELECT DISTINCT f.date AS entry_dt, f.passport_num, TIMESTAMP '{BL_RUN_TS}' AS processed_dt, "
        f"DATE '{BL_DAY}' AS file_date FROM mtd f WHERE f.date = DATE '{BL_DAY}' "
        "AND NOT EXISTS (SELECT 1 FROM blacklist e WHERE e.entry_dt < DATE "
        f"'{BL_DAY}' AND e.passport_num = f.passport_num)",
        [
            ("mtd", f"SELECT entry_dt AS date, passport_num FROM blacklist WHERE entry_dt <= DATE '{BL_DAY}' "
                    f"UNION ALL SELECT DATE '{BL_DAY}', passport_num FROM blacklist WHERE entry_dt <= DATE '{BL_RELIST_UNTIL}'"),
        ],
    ),
)
def load_blacklist(spark, d):
    """L-2 / S-4: slice the file to its day, keep passports not listed before."""
    existing = V.blacklist(spark, d).filter(F.col("entry_dt") < X.date_lit(BL_DAY))
    return L.load_blacklist(existing, blacklist_mtd_file(spark, d), BL_DAY, BL_RUN_TS)


@register(
    "accumulating_file_slice",
    with_views(
        "SELECT date, passport_num FROM mtd WHERE date > DATE '2024-01-10' AND date <= DATE '2024-01-20'",
        [
            ("mtd", f"SELECT entry_dt AS date, passport_num FROM blacklist WHERE entry_dt <= DATE '{BL_DAY}' "
                    f"UNION ALL SELECT DATE '{BL_DAY}', passport_num FROM blacklist WHERE entry_dt <= DATE '{BL_RELIST_UNTIL}'"),
        ],
    ),
)
def accumulating_file_slice(spark, d):
    """S-4 with catch-up: rows of a month-to-date file after the last loaded day."""
    return L.slice_accumulating(blacklist_mtd_file(spark, d), "date", BL_DAY, since="2024-01-10")


@register(
    "normalize_amount",
    with_views(
        "SELECT trans_id, replace(CAST(amt AS VARCHAR), '.', ',') AS amount_text, "
        "CAST(replace(replace(CAST(amt AS VARCHAR), '.', ','), ',', '.') AS DECIMAL(18,2)) AS amt_parsed FROM tx"
    ),
)
def normalize_amount(spark, d):
    """S-2: decimal-comma text amounts parsed to decimal(18,2)."""
    t = V.tx(spark, d).select("trans_id", F.regexp_replace(F.col("amt").cast("string"), "\\.", ",").alias("amount_text"))
    return t.select("trans_id", "amount_text", X.normalize_amount("amount_text").alias("amt_parsed"))


# --------------------------------------------------------------------------
# watermarks

WM_ORDERS = "1998-06-15 13:00:00"
META_VALUES = [
    ("source", "orders", WM_ORDERS),
    ("source", "clients", "2023-06-01 00:00:00"),
    ("source", "transactions", "2024-01-15 00:00:00"),
]
META_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{t}', TIMESTAMP '{w}')" for s, t, w in META_VALUES
) + ") m(schema_name, table_name, max_update_dt)"


def meta_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s, t, w) for s, t, w in META_VALUES], "schema_name string, table_name string, w string"
    ).select("schema_name", "table_name", F.col("w").cast("timestamp_ntz").alias("max_update_dt"))


_INC_PRED = (
    "(update_dt IS NULL AND create_dt >= CAST(CAST(TIMESTAMP '{w}' AS DATE) AS TIMESTAMP)) "
    "OR (update_dt IS NOT NULL AND update_dt >= CAST(CAST(TIMESTAMP '{w}' AS DATE) AS TIMESTAMP))"
)


@register(
    "incremental_extract",
    with_views("SELECT order_key, create_dt, update_dt FROM orders_src WHERE " + _INC_PRED.format(w=WM_ORDERS)),
)
def incremental_extract(spark, d):
    """S-6: rows created or updated since the watermark's day."""
    return ST.incremental_extract(V.orders_src(spark, d), WM_ORDERS).select("order_key", C.CREATE_COL, C.UPDATE_COL)


def _changes(spark, d) -> dict:
    return {
        "orders": ST.incremental_extract(V.orders_src(spark, d), WM_ORDERS),
        "clients": V.clients_src(spark, d),
        "transactions": V.tx(spark, d).select(F.col("trans_date").alias(C.CREATE_COL), F.lit(None).cast("timestamp_ntz").alias(C.UPDATE_COL)),
    }


WATERMARK_EXTRA = [
    ("meta", META_SQL),
    ("news",
     "SELECT 'orders' AS table_name, max(coalesce(update_dt, create_dt)) AS m FROM orders_src WHERE "
     + _INC_PRED.format(w=WM_ORDERS)
     + " UNION ALL SELECT 'clients', max(coalesce(update_dt, create_dt)) FROM clients_src"
     " UNION ALL SELECT 'transactions', max(trans_date) FROM tx"),
    ("adv",
     "SELECT m.schema_name, m.table_name, CASE WHEN n.m IS NULL THEN m.max_update_dt "
     "WHEN n.m > m.max_update_dt THEN n.m ELSE m.max_update_dt END AS max_update_dt "
     "FROM meta m LEFT JOIN news n ON n.table_name = m.table_name"),
]
WATERMARK_ADVANCE_SQL = with_views("SELECT schema_name, table_name, max_update_dt FROM adv", WATERMARK_EXTRA)
WATERMARK_LOOKUP_SQL = with_views(
    "SELECT schema_name, table_name, CAST(max_update_dt AS DATE) AS extract_from FROM adv", WATERMARK_EXTRA
)


@register("watermark_advance", WATERMARK_ADVANCE_SQL)
def watermark_advance(spark, d):
    """M-4 / A-1 / A-2: each table's watermark moves to its latest change, never back."""
    return ST.advance_watermark(meta_table(spark), _changes(spark, d))


@register("watermark_lookup", WATERMARK_LOOKUP_SQL)
def watermark_lookup(spark, d):
    """S-8: the first day the next incremental read includes, per source table."""
    return ST.extraction_bounds(ST.advance_watermark(meta_table(spark), _changes(spark, d)))


# --------------------------------------------------------------------------
# file discovery and load state

_NAMES_SQL = (
    "SELECT DISTINCT 'transactions_' || strftime(trans_date, '%d%m%Y') || '.txt' AS name FROM tx "
    "UNION SELECT DISTINCT 'passport_blacklist_' || strftime(entry_dt, '%d%m%Y') || '.xlsx' FROM blacklist"
)


def file_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of the daily files the warehouse received (derived from the data)."""
    tx_names = V.tx(spark, d).select(F.concat(F.lit("transactions_"), F.date_format("trans_date", "ddMMyyyy"), F.lit(".txt")).alias("name"))
    bl_names = V.blacklist(spark, d).select(
        F.concat(F.lit("passport_blacklist_"), F.date_format("entry_dt", "ddMMyyyy"), F.lit(".xlsx")).alias("name")
    )
    return tx_names.unionByName(bl_names)


@register(
    "discover_file_dates",
    with_views(
        "SELECT CAST(strptime(regexp_extract(name, '([0-9]{8})', 1), '%d%m%Y') AS DATE) AS date_point, "
        "count(DISTINCT name) AS n_files FROM names GROUP BY 1",
        [("names", _NAMES_SQL)],
    ),
)
def discover_file_dates(spark, d):
    """S-9 / S-10 / A-4 / O-1: dates embedded in file names, with files per date."""
    return FS.file_dates(file_names(spark, d))


def _file_rows(spark, d) -> DataFrame:
    names = file_names(spark, d)
    return names.select(X.file_name_date("name").alias("date_point"), FS.file_kind("name").alias("kind")).distinct()


def _points(spark, d, runs: int) -> DataFrame:
    files = _file_rows(spark, d)
    tx_days = files.filter(F.col("kind") == "transactions").select("date_point")
    pts = ST.date_point_rows(tx_days, {"transactions_flg": 1, "event_type_2_rep": 1, "event_type_4_rep": 1})
    if runs > 1:
        bl_days = files.filter(F.col("kind") == "passport_blacklist").select("date_point")
        both = tx_days.join(bl_days, "date_point", "inner")
        pts = pts.unionByName(
            ST.date_point_rows(both, {"transactions_flg": 1, "passport_blacklist_flg": 1, "event_type_1_rep": 1,
                                      "event_type_2_rep": 1, "event_type_4_rep": 1})
        )
    return pts


_DAYS = "SELECT DISTINCT CAST(trans_date AS DATE) AS date_point FROM tx"
_BL_DAYS = "SELECT DISTINCT entry_dt AS date_point FROM blacklist"
_RUN1 = "SELECT date_point, 1 AS transactions_flg, 0 AS passport_blacklist_flg, 0 AS terminals_flg, 0 AS event_type_1_rep, 1 AS event_type_2_rep, 0 AS event_type_3_rep, 1 AS event_type_4_rep FROM days"
_RUN2 = "SELECT d.date_point, 1, 1, 0, 1, 1, 0, 1 FROM days d JOIN bl_days b ON b.date_point = d.date_point"
_STATE = (
    "SELECT date_point, max(transactions_flg) AS transactions_flg, max(passport_blacklist_flg) AS passport_blacklist_flg, "
    "max(terminals_flg) AS terminals_flg, max(event_type_1_rep) AS event_type_1_rep, max(event_type_2_rep) AS event_type_2_rep, "
    "max(event_type_3_rep) AS event_type_3_rep, max(event_type_4_rep) AS event_type_4_rep, "
    "max(event_type_1_rep) + max(event_type_2_rep) + max(event_type_3_rep) + max(event_type_4_rep) AS event_type_all_rep "
    "FROM points GROUP BY date_point"
)


@register(
    "date_point_state",
    with_views(_STATE, [("days", _DAYS), ("bl_days", _BL_DAYS), ("points", _RUN1 + " UNION ALL " + _RUN2)]),
)
def date_point_state(spark, d):
    """S-11 / K-6 / A-3 / O-2: latest load state per date from appended state rows."""
    return ST.latest_state(_points(spark, d, 2))


@register(
    "ready_reports",
    with_views(
        "SELECT COALESCE(s.date_point, f.date_point) AS date_point, "
        "greatest(COALESCE(s.transactions_flg, 0), COALESCE(f.tf, 0)) AS transactions_flg, "
        "greatest(COALESCE(s.passport_blacklist_flg, 0), COALESCE(f.bf, 0)) AS passport_blacklist_flg, "
        "greatest(COALESCE(s.terminals_flg, 0), COALESCE(f.mf, 0)) AS terminals_flg, "
        "(greatest(COALESCE(s.transactions_flg, 0), COALESCE(f.tf, 0)) = 1 AND greatest(COALESCE(s.passport_blacklist_flg, 0), COALESCE(f.bf, 0)) = 1 AND COALESCE(s.event_type_1_rep, 0) = 0) AS run_rule_1, "
        "(greatest(COALESCE(s.transactions_flg, 0), COALESCE(f.tf, 0)) = 1 AND COALESCE(s.event_type_2_rep, 0) = 0) AS run_rule_2, "
        "(greatest(COALESCE(s.transactions_flg, 0), COALESCE(f.tf, 0)) = 1 AND greatest(COALESCE(s.terminals_flg, 0), COALESCE(f.mf, 0)) = 1 AND COALESCE(s.event_type_3_rep, 0) = 0) AS run_rule_3, "
        "(greatest(COALESCE(s.transactions_flg, 0), COALESCE(f.tf, 0)) = 1 AND COALESCE(s.event_type_4_rep, 0) = 0) AS run_rule_4 "
        "FROM state s FULL OUTER JOIN files f ON f.date_point = s.date_point",
        [
            ("days", _DAYS), ("bl_days", _BL_DAYS), ("points", _RUN1),
            ("state", _STATE),
            ("files", "SELECT date_point, max(CASE WHEN kind = 'transactions' THEN 1 ELSE 0 END) AS tf, "
                      "max(CASE WHEN kind = 'passport_blacklist' THEN 1 ELSE 0 END) AS bf, "
                      "max(CASE WHEN kind = 'terminals' THEN 1 ELSE 0 END) AS mf FROM "
                      "(SELECT date_point, 'transactions' AS kind FROM days UNION ALL SELECT date_point, 'passport_blacklist' FROM bl_days) "
                      "GROUP BY date_point"),
        ],
    ),
)
def ready_reports(spark, d):
    """O-3: after the first run, which rules become runnable once the received files are loaded."""
    return ST.ready_reports(ST.latest_state(_points(spark, d, 1)), _file_rows(spark, d))


# --------------------------------------------------------------------------
# constraint checks


@register(
    "dq_fk_orphans",
    with_views(
        "SELECT terminal, count(*) AS n_orphans FROM tx t WHERE NOT EXISTS "
        "(SELECT 1 FROM terminals_a a WHERE a.terminal_id = t.terminal) GROUP BY terminal"
    ),
)
def dq_fk_orphans(spark, d):
    """O-5 foreign key: operations at terminals missing from the terminal snapshot."""
    o = Q.orphans(V.tx(spark, d).select("terminal"), V.terminal_snapshot(spark, d, "a"), "terminal", "terminal_id")
    return o.groupBy("terminal").agg(F.count(F.lit(1)).alias("n_orphans"))


@register(
    "dq_validity_overlap",
    with_views(
        "SELECT cust_key, order_key, effective_from, effective_to, issue FROM ("
        "SELECT *, CASE WHEN effective_to < effective_from THEN 'inverted' "
        "WHEN nxt IS NOT NULL AND nxt <= effective_to THEN 'overlap' "
        "WHEN nxt IS NOT NULL AND nxt > effective_to + INTERVAL 1 MILLISECOND THEN 'gap' END AS issue FROM ("
        "SELECT *, lead(effective_from) OVER (PARTITION BY cust_key ORDER BY effective_from, order_key) AS nxt FROM closed)) "
        "WHERE issue IS NOT NULL",
        [("closed",
          "SELECT cust_key, order_key, effective_from, COALESCE(lead(effective_from) OVER "
          "(PARTITION BY cust_key ORDER BY effective_from, order_key) - INTERVAL 1 MILLISECOND, "
          f"{_TS_INF}) AS effective_to FROM versions")],
    ),
)
def dq_validity_overlap(spark, d):
    """O-5 validity: closed version intervals that invert, overlap or leave gaps."""
    closed = S.scd2_close(V.versions(spark, d).select("cust_key", "order_key", C.FROM_COL), "cust_key", "ms", ["order_key"])
    return Q.validity_violations(closed, "cust_key", "ms", ["order_key"])


@register(
    "dq_duplicate_keys",
    with_views("SELECT cust_key, effective_from, count(*) AS n_rows FROM versions GROUP BY cust_key, effective_from HAVING count(*) > 1"),
)
def dq_duplicate_keys(spark, d):
    """O-5 primary key: (key, effective_from) pairs occurring more than once."""
    return Q.duplicate_keys(V.versions(spark, d), ["cust_key", C.FROM_COL])


CLIENT_TEXT = ["client_id", "last_name", "first_name", "patronymic", "passport_num", "phone"]


@register(
    "dq_string_length",
    with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, max(length({c})) AS max_length, {C.STRING_LIMITS[c]} AS length_limit, "
        f"count(*) FILTER (WHERE length({c}) > {C.STRING_LIMITS[c]}) AS n_over FROM clients_hist"
        for c in CLIENT_TEXT
    )),
)
def dq_string_length(spark, d):
    """O-5 declared text lengths: longest value and violations per column of the client history."""
    return Q.length_report(V.clients_hist(spark, d), {c: C.STRING_LIMITS[c] for c in CLIENT_TEXT})


CLIENT_SRC_COLUMNS = ["client_id", "last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                      "passport_valid_to", "phone", "create_dt", "update_dt"]


@register(
    "dq_null_counts",
    with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM clients_src" for c in CLIENT_SRC_COLUMNS
    )),
)
def dq_null_counts(spark, d):
    """O-5 NOT NULL: NULLs per column of the client source (passport end dates and update times may be NULL)."""
    return Q.null_report(V.clients_src(spark, d), CLIENT_SRC_COLUMNS)


@register(
    "scd2_change_summary",
    with_views(
        "SELECT change_action, count(*) AS n_keys FROM ("
        "SELECT CASE WHEN a.cust_key IS NULL THEN 'INSERT' WHEN b.cust_key IS NULL THEN 'DELETE' "
        "WHEN a.priority IS DISTINCT FROM b.priority OR a.status IS DISTINCT FROM b.status THEN 'UPDATE' ELSE 'KEEP' END AS change_action "
        "FROM status_a a FULL OUTER JOIN status_b b ON a.cust_key = b.cust_key) GROUP BY change_action"
    ),
)
def scd2_change_summary(spark, d):
    """Key classification between two states of a source (insert / update /
    delete / keep), counted per action."""
    actions = S.classify_changes(V.status(spark, d, "a"), V.status(spark, d, "b"), "cust_key", STATUS_TRACKED)
    return actions.groupBy(S.ACTION_COL).agg(F.count(F.lit(1)).alias("n_keys"))
