"""Which report days an input that arrives late or is corrected touches.

Every function returns (report_dt, event_type) pairs, one per day and rule
whose result can differ, found from what changed: the operations of a load and
the window after them, new blacklist entries, or the difference between two
states of a dimension history.  Only keys that changed are joined to the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

ALL_RULES = (1, 2, 3, 4)
PAIR = ["report_dt", "event_type"]


def _rules(days: DataFrame, rules: Sequence[int]) -> DataFrame:
    types = F.explode(F.array(*[F.lit(int(r)) for r in rules])).alias("event_type")
    return days.where("report_dt is not null").distinct().select("report_dt", types)


def _until(ts: Column, seconds: int) -> Column:
    """The days on which an operation at ``ts`` is inside some window."""
    last = F.to_date(ts + F.expr(f"INTERVAL '{int(seconds)}' SECOND"))
    return F.explode(F.sequence(F.to_date(ts), last)).alias("report_dt")


def days_of_operations(
    changed_tx: DataFrame,
    city_window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    probe_window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
) -> DataFrame:
    """Rules 1 and 2 on the day of every added or removed operation; rules 3
    and 4 also on the days its window reaches.  (An operation changes the
    predecessors of later ones only while it is inside their window.)"""
    ts = changed_tx.select("trans_date").where("trans_date is not null")
    return (
        _rules(ts.select(F.to_date("trans_date").alias("report_dt")), (1, 2))
        .unionByName(_rules(ts.select(_until(F.col("trans_date"), city_window_seconds)), (3,)))
        .unionByName(_rules(ts.select(_until(F.col("trans_date"), probe_window_seconds)), (4,)))
    )


def history_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str], grain: str) -> DataFrame:
    """keys, lo, hi: the intervals in which the two histories say different
    things about a key.  A version that only got another end differs between
    the two ends; one that stands in a single history differs over its length.
    One aggregate over both (nulls compare equal), no join."""
    same = [*keys, *tracked, C.FROM_COL, C.FLAG_COL]
    null = F.lit(None).cast(old.schema[C.TO_COL].dataType)
    both = old.select(*same, F.col(C.TO_COL).alias("_o"), null.alias("_n")).unionByName(
        new.select(*same, null.alias("_o"), F.col(C.TO_COL).alias("_n"))
    )
    ends = both.groupBy(*same).agg(F.max("_o").alias("_o"), F.max("_n").alias("_n")).where("not _o <=> _n")
    moved = F.col("_o").isNotNull() & F.col("_n").isNotNull()
    return ends.select(
        *keys,
        F.when(moved, X.shift(F.least("_o", "_n"), grain, 1)).otherwise(F.col(C.FROM_COL)).alias("lo"),
        F.greatest("_o", "_n").alias("hi"),
    )


def _narrow(versions: DataFrame, on: str, changed: DataFrame, changed_on: str, out: str) -> DataFrame:
    """``out`` key of the versions that name a changed key, and where both hold."""
    v = versions.select(F.col(on).alias("_on"), F.col(out), F.col(C.FROM_COL).alias("_f"), F.col(C.TO_COL).alias("_t"))
    c = changed.select(F.col(changed_on).alias("_on"), "lo", "hi")
    joined = v.join(c, "_on").select(out, F.greatest("lo", "_f").alias("lo"), F.least("hi", "_t").alias("hi"))
    return joined.where("lo <= hi").distinct()


def changed_cards(diff: DataFrame, dim: str, cards: DataFrame, accounts: DataFrame) -> DataFrame:
    """card_num, lo, hi: where a changed card, account or client shows through."""
    if dim == "clients":
        diff, dim = _narrow(accounts, "client", diff, "client_id", "account_num"), "accounts"
    if dim == "accounts":
        diff = _narrow(cards, "account_num", diff, "account_num", "card_num")
    return diff.select("card_num", "lo", "hi")


def days_of_cards(tx: DataFrame, intervals: DataFrame, rules: Sequence[int] = ALL_RULES) -> DataFrame:
    """The days with an operation of a card inside one of its intervals."""
    i = intervals.select(F.col("card_num").alias("_c"), "lo", "hi")
    inside = (F.col("card_num") == F.col("_c")) & F.col("trans_date").between(F.col("lo"), F.col("hi"))
    return _rules(tx.join(i, inside, "left_semi").select(F.to_date("trans_date").alias("report_dt")), rules)


def days_of_listings(tx: DataFrame, listings: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """Rule 1 on the days, from the entry on, with an operation of a client
    who holds a newly listed passport."""
    p = listings.select(F.col("passport_num").alias("_p"), F.col("entry_dt").cast("timestamp_ntz").alias("_e"))
    held = clients.join(p, F.col("passport_num") == F.col("_p")).select(
        "client_id", F.greatest(F.col("_e"), F.col(C.FROM_COL)).alias("lo"), F.col(C.TO_COL).alias("hi")
    ).where("lo <= hi")
    return days_of_cards(tx, changed_cards(held, "clients", cards, accounts), (1,))


def days_of_terminals(tx: DataFrame, diff: DataFrame, city_window_seconds: int = C.CITY_HOP_WINDOW_SECONDS) -> DataFrame:
    """Rule 3 on the days reached by an operation at a terminal whose city,
    or whether it is known, has changed for that day."""
    d = diff.select(F.col("terminal_id").alias("_id"), "lo", "hi")
    at = (F.col("terminal") == F.col("_id")) & F.to_date("trans_date").between(F.col("lo"), F.col("hi"))
    return _rules(tx.join(d, at, "left_semi").select(_until(F.col("trans_date"), city_window_seconds)), (3,))
