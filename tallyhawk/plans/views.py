"""Banking-shaped warehouse views over the driver tables.

Each view is deterministic and has a twin written in SQL in
:mod:`tallyhawk.plans.oracle_views`; the two must stay in step.  They map the
generic tables onto the warehouse model:

* ``tx``              events -> transactions fact
* ``tx_close``        the same with a month's operations within its first 32 minutes
* ``clients_hist``    customer -> client history (a passport change for the
                      AUTOMOBILE segment, month-day and hour from the key)
* ``accounts_hist``   customer -> account history (accounts of customers with
                      a balance above 9000 are closed: delete marker)
* ``cards_hist``      customer -> one card per account
* ``blacklist``       customers with a negative balance
* ``terminals_hist``  terminals seen in events -> city of nation ``k % 25``;
                      terminals of region-0 nations move to the next nation
                      on 2024-01-15
* ``terminal_snapshot('a'|'b')`` two full snapshots for snapshot merges
                      (membership and moves by the nation's region)
* ``status('a'|'b')`` latest order priority/status per customer before 1998 / over all orders
                      (a changing SCD1 source for incremental merges)
* ``versions``        orders as versions of a customer (interval closing)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

DIM_START_TS = "2023-01-01 00:00:00"
DIM_START_DATE = "2023-01-01"
TERMINAL_MOVE_DATE = "2024-01-15"
REJECT_TYPES = ("error", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days_from(start: str, n) -> F.Column:
    return F.date_add(X.date_lit(start), n.cast("int"))


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("trans_id"),
        F.col("ts").alias("trans_date"),  # stored as is: filters on it reach the Parquet scan
        F.col("value").cast("decimal(18,2)").alias("amt"),
        F.col("user_id").cast("string").alias("card_num"),
        F.col("event_type").alias("oper_type"),
        F.when(F.col("event_type").isin(*REJECT_TYPES), F.lit(C.REJECT)).otherwise(F.lit(C.SUCCESS)).alias("oper_result"),
        F.regexp_extract("props", "[0-9]+", 0).alias("terminal"),
    )


def tx_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction, with a month's days moved to minutes and its hours to
    seconds: cards operate often enough to meet windows of minutes."""
    t = F.col("trans_date")
    moved = F.trunc(t, "month").cast("timestamp_ntz") + F.make_dt_interval(mins=F.dayofmonth(t), secs=F.hour(t))
    return tx(spark, sf_dir).withColumn("trans_date", moved)


def _client_change_ts(k) -> F.Column:
    return X.ts_lit("2024-01-01 00:00:00") + F.make_dt_interval(
        days=(k % 28).cast("int"), hours=(k % 24).cast("int")
    )


def _versions(df: DataFrame, *versions) -> DataFrame:
    """Emit up to one row per version struct (NULL structs are skipped) from a
    single scan of ``df``."""
    arr = F.filter(F.array(*versions), lambda v: v.isNotNull())
    return df.select(F.explode(arr).alias("_v")).select("_v.*")


def clients_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    changes = F.col("c_mktsegment") == F.lit("AUTOMOBILE")
    common = [
        k.cast("string").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("patronymic"),
        _days_from("1950-01-01", k * 37 % 18000).alias("date_of_birth"),
    ]
    first = F.struct(
        *common,
        F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
        F.when(k % 11 == 0, X.inf_date()).otherwise(_days_from("2024-01-01", k * 7 % 90)).alias("passport_valid_to"),
        k.cast("string").alias("phone"),
        X.ts_lit(DIM_START_TS).alias(C.FROM_COL),
        F.when(changes, X.shift(_client_change_ts(k), "ms", -1)).otherwise(X.inf_ts()).alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
    )
    second = F.when(changes, F.struct(
        *common,
        F.concat(F.lit("Q"), k.cast("string")).alias("passport_num"),
        _days_from("2024-01-01", k * 3 % 60).alias("passport_valid_to"),
        F.concat(F.lit("+"), k.cast("string")).alias("phone"),
        _client_change_ts(k).alias(C.FROM_COL),
        X.inf_ts().alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
    ))
    return _versions(c, first, second)


def _account_close_ts(k) -> F.Column:
    return X.ts_lit("2024-01-10 00:00:00") + F.make_dt_interval(days=(k % 20).cast("int"))


def accounts_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    closes = F.col("c_acctbal") > 9000
    common = [
        k.cast("string").alias("account_num"),
        _days_from("2024-01-01", k % 60).alias("valid_to"),
        k.cast("string").alias("client"),
    ]
    first = F.struct(
        *common,
        X.ts_lit(DIM_START_TS).alias(C.FROM_COL),
        F.when(closes, X.shift(_account_close_ts(k), "ms", -1)).otherwise(X.inf_ts()).alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
    )
    marker = F.when(closes, F.struct(
        *common,
        _account_close_ts(k).alias(C.FROM_COL),
        X.inf_ts().alias(C.TO_COL),
        F.lit(C.DELETED).alias(C.FLAG_COL),
    ))
    return _versions(c, first, marker)


def cards_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    return c.select(
        k.alias("card_num"),
        k.alias("account_num"),
        X.ts_lit(DIM_START_TS).alias(C.FROM_COL),
        X.inf_ts().alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    entry = _days_from("2024-01-01", k % 30)
    return c.filter(F.col("c_acctbal") < 0).select(
        entry.alias("entry_dt"),
        F.concat(F.lit("P"), k.cast("string")).alias("passport_num"),
        entry.alias(C.FILE_DATE_COL),
    )


def _terminal_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ids = e.select(F.regexp_extract("props", "[0-9]+", 0).alias("terminal_id")).distinct()
    return ids.withColumn("_tk", F.col("terminal_id").cast("int"))


def _nation(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").alias(f"{prefix}key"),
        F.col("n_name").alias(f"{prefix}name"),
        F.col("n_regionkey").alias(f"{prefix}region"),
    )


def _terminal_attrs() -> list:
    return [
        F.col("terminal_id"),
        F.when(F.col("_tk") % 2 == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
    ]


def terminals_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _terminal_ids(spark, sf_dir)
    n1 = _nation(spark, sf_dir, "_n1")
    n2 = _nation(spark, sf_dir, "_n2")
    t = ids.join(n1, (F.col("_tk") % 25) == F.col("_n1key")).join(n2, ((F.col("_tk") + 1) % 25) == F.col("_n2key"))
    moves = F.col("_n1region") == 0
    address = F.concat(F.lit("street "), F.col("terminal_id")).alias("terminal_address")
    first = F.struct(
        *_terminal_attrs(),
        F.col("_n1name").alias("terminal_city"),
        address,
        X.date_lit(DIM_START_DATE).alias(C.FROM_COL),
        F.when(moves, F.date_sub(X.date_lit(TERMINAL_MOVE_DATE), 1)).otherwise(X.inf_date()).alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
        X.date_lit(DIM_START_DATE).alias(C.FILE_DATE_COL),
    )
    second = F.when(moves, F.struct(
        *_terminal_attrs(),
        F.col("_n2name").alias("terminal_city"),
        address,
        X.date_lit(TERMINAL_MOVE_DATE).alias(C.FROM_COL),
        X.inf_date().alias(C.TO_COL),
        F.lit(C.LIVE).alias(C.FLAG_COL),
        X.date_lit(TERMINAL_MOVE_DATE).alias(C.FILE_DATE_COL),
    ))
    return _versions(t, first, second)


# Snapshot membership by region of the terminal's nation: snapshot 'a' lacks
# the terminals of region 4 (opened later), snapshot 'b' lacks those of
# region 3 (closed) and has the terminals of region 2 moved to the next nation.
SNAPSHOT_A_MISSING_REGION = 4
SNAPSHOT_B_MISSING_REGION = 3
SNAPSHOT_B_MOVED_REGION = 2


def terminal_snapshot(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Full terminal snapshot 'a' or 'b' (see the region constants above)."""
    ids = _terminal_ids(spark, sf_dir)
    n1 = _nation(spark, sf_dir, "_n1")
    n2 = _nation(spark, sf_dir, "_n2")
    t = ids.join(n1, (F.col("_tk") % 25) == F.col("_n1key")).join(n2, ((F.col("_tk") + 1) % 25) == F.col("_n2key"))
    if which == "a":
        t = t.filter(F.col("_n1region") != SNAPSHOT_A_MISSING_REGION)
        city = F.col("_n1name")
    else:
        t = t.filter(F.col("_n1region") != SNAPSHOT_B_MISSING_REGION)
        city = F.when(F.col("_n1region") == SNAPSHOT_B_MOVED_REGION, F.col("_n2name")).otherwise(F.col("_n1name"))
    return t.select(
        *_terminal_attrs(),
        city.alias("terminal_city"),
        F.concat(F.lit("street "), F.col("terminal_id")).alias("terminal_address"),
    )


#: State a is taken before this cut, state b over all orders; customers whose
#: key modulo 10 is the given number are missing from that state.
STATUS_CUT = "1998-01-01"
STATUS_MISSING = {"a": 3, "b": 7}


def status(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Latest order priority and status per customer, at the cut or in all."""
    o = table(spark, sf_dir, "orders").filter((F.col("o_custkey") % 10) != STATUS_MISSING[which])
    if which == "a":
        o = o.filter(F.col("o_orderdate") < X.ts_lit(f"{STATUS_CUT} 00:00:00"))
    # latest order per customer as an aggregate (map-side partial max), not a
    # per-customer window: a customer with a huge share of orders stays cheap
    latest = o.groupBy("o_custkey").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus")).alias("_m")
    )
    return latest.select(
        F.col("o_custkey").alias("cust_key"),
        F.col("_m.o_orderpriority").alias("priority"),
        F.when(F.col("_m.o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(F.col("_m.o_orderstatus")).alias("status"),
        # a customer new in state b enters the source after the cut
        F.when(
            F.lit(which == "b") & (F.col("o_custkey") % 10 == STATUS_MISSING["a"]),
            F.greatest(F.col("_m.o_orderdate"), X.ts_lit(f"{STATUS_CUT} 00:00:00")),
        ).otherwise(F.col("_m.o_orderdate")).alias("changed_at"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of their customer: start = order date."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("cust_key"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias(C.FROM_COL),
    )


def clients_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state (SCD1) of the client source with create/update times;
    ``passport_valid_to`` is NULL for passports without an end date."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    changes = F.col("c_mktsegment") == F.lit("AUTOMOBILE")
    return c.select(
        k.cast("string").alias("client_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("patronymic"),
        _days_from("1950-01-01", k * 37 % 18000).alias("date_of_birth"),
        F.concat(F.when(changes, F.lit("Q")).otherwise(F.lit("P")), k.cast("string")).alias("passport_num"),
        F.when(changes, _days_from("2024-01-01", k * 3 % 60))
        .when(k % 11 == 0, F.lit(None).cast("date"))
        .otherwise(_days_from("2024-01-01", k * 7 % 90))
        .alias("passport_valid_to"),
        F.when(changes, F.concat(F.lit("+"), k.cast("string"))).otherwise(k.cast("string")).alias("phone"),
        (X.ts_lit(DIM_START_TS) + F.make_dt_interval(days=(k % 365).cast("int"))).alias(C.CREATE_COL),
        F.when(changes, _client_change_ts(k)).alias(C.UPDATE_COL),
    )


def orders_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a current-state source: finished orders were updated 30 days
    after they were created."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("cust_key"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias(C.CREATE_COL),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias(C.UPDATE_COL),
    )
