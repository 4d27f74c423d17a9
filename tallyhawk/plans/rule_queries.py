"""Registered rule, report and as-of queries (Spark builder + DuckDB oracle).

Every builder reads the whole driver tables through :mod:`views` and runs a
library operator over them; :data:`ORACLE` holds an independent SQL
formulation of the same result (column names identical).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C
from tallyhawk.operators import rules as R
from tallyhawk.plans import views as V
from tallyhawk.plans.oracle_views import with_views
from tallyhawk.plans.registry import register

# With the 20-minute default no card in the driver data probes amounts (0 hits
# at every size), so these queries widen the window of rule 4; the default runs
# in rule4_amount_probe_20min, over a view whose cards operate more often.
WIDE_PROBE_SECONDS = 7 * 86400
WIDE_PROBE_SQL = "INTERVAL 7 DAY"


def dims(spark: SparkSession, d: str) -> R.Dimensions:
    return R.Dimensions(cards=V.cards_hist(spark, d), accounts=V.accounts_hist(spark, d), clients=V.clients_hist(spark, d))


# ---------------------------------------------------------------- SQL pieces

_ASOF = "{t}.trans_date BETWEEN {d}.effective_from AND {d}.effective_to AND {d}.deleted_flg = 'N'"


def _chain(t: str, kind: str) -> str:
    """card -> account -> client as-of joins (INNER or LEFT per link)."""
    k1, k2, k3 = kind.split(",")
    return (
        f" {k1} JOIN cards_hist c ON c.card_num = {t}.card_num AND " + _ASOF.format(t=t, d="c")
        + f" {k2} JOIN accounts_hist a ON a.account_num = c.account_num AND " + _ASOF.format(t=t, d="a")
        + f" {k3} JOIN clients_hist p ON p.client_id = a.client AND " + _ASOF.format(t=t, d="p")
    )


def _report_select(t: str, event_type: int) -> str:
    return (
        f"SELECT {t}.trans_date AS event_dt, p.passport_num AS passport, "
        "p.last_name || ' ' || p.first_name || ' ' || p.patronymic AS fio, p.phone AS phone, "
        f"{event_type} AS event_type, CAST({t}.trans_date AS DATE) AS report_dt"
    )


RULE1_SQL = (
    _report_select("t", 1)
    + " FROM tx t"
    + _chain("t", "INNER,INNER,INNER")
    + " WHERE p.passport_valid_to < CAST(t.trans_date AS DATE)"
    " OR p.passport_num IN (SELECT b.passport_num FROM blacklist b WHERE b.entry_dt <= CAST(t.trans_date AS DATE))"
)

RULE2_SQL = (
    _report_select("t", 2)
    + " FROM tx t"
    + _chain("t", "INNER,INNER,LEFT")
    + " WHERE a.valid_to < CAST(t.trans_date AS DATE)"
)

RULE3_HITS = """
SELECT trans_id, trans_date, card_num FROM (
  SELECT r.*, lag(r.trans_date) OVER w AS prev_ts, lag(r.city) OVER w AS prev_city
  FROM (SELECT t.trans_id, t.trans_date, t.card_num, h.terminal_city AS city
        FROM tx t JOIN terminals_hist h
          ON h.terminal_id = t.terminal
         AND CAST(t.trans_date AS DATE) BETWEEN h.effective_from AND h.effective_to
         AND h.deleted_flg = 'N' AND h.file_date <= CAST(t.trans_date AS DATE)) r
  WINDOW w AS (PARTITION BY r.card_num ORDER BY r.trans_date, r.trans_id))
WHERE trans_date - prev_ts <= INTERVAL 1 HOUR AND city <> prev_city"""

RULE3_SQL = with_views(_report_select("x", 3) + " FROM rule3_hits x" + _chain("x", "LEFT,LEFT,LEFT"), [("rule3_hits", RULE3_HITS)])

def _rule4_hits(tx: str, window: str) -> str:
    return f"""
SELECT trans_id, trans_date, card_num FROM (
  SELECT trans_id, trans_date, card_num, amt, oper_result,
         lag(trans_date, 3) OVER w AS ts3,
         lag(oper_result, 1) OVER w AS r1, lag(oper_result, 2) OVER w AS r2, lag(oper_result, 3) OVER w AS r3,
         lag(amt, 1) OVER w AS a1, lag(amt, 2) OVER w AS a2, lag(amt, 3) OVER w AS a3
  FROM {tx} WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id))
WHERE oper_result = 'SUCCESS' AND r1 = 'REJECT' AND r2 = 'REJECT' AND r3 = 'REJECT'
  AND a3 > a2 AND a2 > a1 AND a1 > amt AND trans_date - ts3 <= {window}"""


RULE4_HITS = _rule4_hits("tx", WIDE_PROBE_SQL)

RULE4_SQL = with_views(_report_select("x", 4) + " FROM rule4_hits x" + _chain("x", "LEFT,LEFT,LEFT"), [("rule4_hits", RULE4_HITS)])

FRAUD_EXTRA = [
    ("r1", RULE1_SQL),
    ("r2", RULE2_SQL),
    ("rule3_hits", RULE3_HITS),
    ("r3", _report_select("x", 3) + " FROM rule3_hits x" + _chain("x", "LEFT,LEFT,LEFT")),
    ("rule4_hits", RULE4_HITS),
    ("r4", _report_select("x", 4) + " FROM rule4_hits x" + _chain("x", "LEFT,LEFT,LEFT")),
]
FRAUD_UNION = "SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4"
FRAUD_REPORT_SQL = with_views(FRAUD_UNION, FRAUD_EXTRA)
FRAUD_SUMMARY_SQL = with_views(
    f"SELECT report_dt, event_type, count(*) AS n_events FROM ({FRAUD_UNION}) u GROUP BY report_dt, event_type",
    FRAUD_EXTRA,
)


def _fraud_report(spark: SparkSession, d: str) -> DataFrame:
    return R.fraud_report(
        V.tx(spark, d), dims(spark, d), V.terminals_hist(spark, d), V.blacklist(spark, d),
        probe_window_seconds=WIDE_PROBE_SECONDS,
    )


# ---------------------------------------------------------------- rules


@register("rule1_passport", with_views(RULE1_SQL))
def rule1_passport(spark, d):
    """R-1 over every day: expired or blacklisted passport."""
    return R.rule_passport(V.tx(spark, d), dims(spark, d), V.blacklist(spark, d))


@register("rule2_expired_contract", with_views(RULE2_SQL))
def rule2_expired_contract(spark, d):
    """R-2 over every day: contract ended before the operation day."""
    return R.rule_contract(V.tx(spark, d), dims(spark, d))


@register("rule3_city_hop", RULE3_SQL)
def rule3_city_hop(spark, d):
    """R-3 over every day: another city within one hour."""
    return R.rule_city_hop(V.tx(spark, d), V.terminals_hist(spark, d), dims(spark, d))


@register("rule4_amount_probe", RULE4_SQL)
def rule4_amount_probe(spark, d):
    """R-4 over every day: falling amounts, 3 rejects then a success."""
    return R.rule_amount_probe(V.tx(spark, d), dims(spark, d), window_seconds=WIDE_PROBE_SECONDS)


@register(
    "rule4_amount_probe_20min",
    with_views(
        _report_select("x", 4) + " FROM rule4_hits x" + _chain("x", "LEFT,LEFT,LEFT"),
        [("rule4_hits", _rule4_hits("tx_close", "INTERVAL 20 MINUTE"))],
    ),
)
def rule4_amount_probe_20min(spark, d):
    """R-4 with its default window, over every operation of the closer view."""
    return R.rule_amount_probe(V.tx_close(spark, d), dims(spark, d))


@register("fraud_report", FRAUD_REPORT_SQL)
def fraud_report(spark, d):
    """U-3: the four rules accumulated into one report."""
    return _fraud_report(spark, d)


@register("fraud_summary_by_type", FRAUD_SUMMARY_SQL)
def fraud_summary_by_type(spark, d):
    """Report rows per day and event type."""
    return R.report_summary(_fraud_report(spark, d))


@register(
    "event_type_descriptions",
    with_views(
        "SELECT e.event_type, e.description, count(u.event_type) AS n_events FROM (VALUES "
        + ", ".join(f"({t}, '{text}')" for t, text in C.EVENT_TYPES)
        + f") e(event_type, description) LEFT JOIN ({FRAUD_UNION}) u ON u.event_type = e.event_type"
        " GROUP BY e.event_type, e.description",
        FRAUD_EXTRA,
    ),
)
def event_type_descriptions(spark, d):
    """K-7: every event type of the seeded dimension with its report rows."""
    counts = _fraud_report(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return R.event_types(spark).join(counts, "event_type", "left").select(
        "event_type", "description", F.coalesce("n", F.lit(0)).alias("n_events")
    )


# ---------------------------------------------------------------- as-of joins and enrichment


@register(
    "enrich_transactions",
    with_views(
        "SELECT t.trans_id, t.trans_date AS event_dt, p.passport_num AS passport, "
        "p.last_name || ' ' || p.first_name || ' ' || p.patronymic AS fio, p.phone AS phone, "
        "a.valid_to AS contract_valid_to, CAST(t.trans_date AS DATE) AS report_dt FROM tx t"
        + _chain("t", "LEFT,LEFT,LEFT")
    ),
)
def enrich_transactions(spark, d):
    """E-1: every transaction with the card/account/client versions valid at its time."""
    e = R.enrich_transactions(V.tx(spark, d), dims(spark, d), how="left")
    return e.select(
        "trans_id",
        F.col("trans_date").alias("event_dt"),
        F.col("_p_passport").alias("passport"),
        F.col("_p_fio").alias("fio"),
        F.col("_p_phone").alias("phone"),
        F.col("_a_valid_to").alias("contract_valid_to"),
        F.to_date("trans_date").alias("report_dt"),
    )


@register(
    "asof_validity_join",
    with_views(
        "SELECT t.trans_id, h.terminal_city, h.effective_from AS terminal_version_from "
        "FROM tx t JOIN terminals_hist h ON h.terminal_id = t.terminal "
        "AND CAST(t.trans_date AS DATE) BETWEEN h.effective_from AND h.effective_to AND h.deleted_flg = 'N'"
    ),
)
def asof_validity_join(spark, d):
    """J-5 with DATE-grain versions: the terminal version valid on the operation day."""
    from tallyhawk.operators.asof import asof_join, live_versions

    term = live_versions(V.terminals_hist(spark, d)).select(
        F.col("terminal_id").alias("_t_id"),
        F.col("terminal_city"),
        F.col("effective_from").alias("terminal_version_from"),
        F.col("effective_to").alias("_t_to"),
    )
    t = V.tx(spark, d).select("trans_id", "trans_date", "terminal")
    j = asof_join(t, term, "terminal", "_t_id", "trans_date", "terminal_version_from", "_t_to", grain="day", how="inner")
    return j.select("trans_id", "terminal_city", "terminal_version_from")


@register(
    "asof_validity_carried",
    with_views(
        "SELECT t.trans_id, h.terminal_city, h.effective_from AS terminal_version_from "
        "FROM tx t LEFT JOIN terminals_hist h ON h.terminal_id = t.terminal "
        "AND CAST(t.trans_date AS DATE) BETWEEN h.effective_from AND h.effective_to AND h.deleted_flg = 'N'"
    ),
)
def asof_validity_carried(spark, d):
    """J-5 in linear time, left semantics: every operation with the terminal
    version valid on its day, carried forward instead of paired."""
    from tallyhawk.operators.asof import live_versions
    from tallyhawk.operators.sequence import asof_carried

    term = live_versions(V.terminals_hist(spark, d)).select(
        F.col("terminal_id").alias("_t_id"),
        F.col("terminal_city"),
        F.col("effective_from").alias("terminal_version_from"),
        F.col("effective_to").alias("_t_to"),
    )
    t = V.tx(spark, d).select("trans_id", "trans_date", "terminal")
    j = asof_carried(t, term, "terminal", "_t_id", "trans_date", "terminal_version_from", "_t_to", grain="day")
    return j.select("trans_id", "terminal_city", "terminal_version_from")


_PREV = "lag({v}, {k}) OVER (PARTITION BY t.card_num ORDER BY t.trans_date, t.trans_id) AS {n}{k}"


@register(
    "card_previous_operations",
    with_views(
        "SELECT t.trans_id, t.card_num, "
        + ", ".join(_PREV.format(v=f"t.{v}", k=k, n=n) for k in (1, 2, 3) for v, n in (("trans_date", "prev_ts"), ("oper_result", "prev_result"), ("amt", "prev_amt")))
        + " FROM tx t WHERE t.card_num IS NOT NULL"
    ),
)
def card_previous_operations(spark, d):
    """W-3..W-7: the three operations before each one of a card, the card's
    operations cut by row count (the columns that rule 4 compares)."""
    from tallyhawk.operators.sequence import with_previous

    t = V.tx(spark, d).select("trans_id", "card_num", "trans_date", "oper_result", "amt").where("card_num is not null")
    p = with_previous(t, "card_num", ["trans_date", "trans_id"], ["trans_date", "oper_result", "amt"], depth=3)
    names = (("trans_date", "prev_ts"), ("oper_result", "prev_result"), ("amt", "prev_amt"))
    return p.select("trans_id", "card_num", *[F.col(f"_prev{k}_{v}").alias(f"{n}{k}") for k in (1, 2, 3) for v, n in names])


@register(
    "blacklist_asof",
    with_views(
        "SELECT t.trans_id, p.passport_num, "
        "(SELECT min(b.entry_dt) FROM blacklist b WHERE b.passport_num = p.passport_num) AS first_listed "
        "FROM tx t" + _chain("t", "INNER,INNER,INNER")
        + " WHERE EXISTS (SELECT 1 FROM blacklist b WHERE b.passport_num = p.passport_num "
        "AND b.entry_dt <= CAST(t.trans_date AS DATE))"
    ),
)
def blacklist_asof(spark, d):
    """J-7: operations whose client passport was blacklisted on or before the operation day."""
    chain = R.card_account_clients(dims(spark, d))
    chain = chain.join(R.first_listing(V.blacklist(spark, d)), F.col("_p_passport") == F.col("_bl_passport"), "inner")
    from tallyhawk.operators.asof import asof_join

    t = asof_join(V.tx(spark, d).select("trans_id", "trans_date", "card_num"), chain, "card_num", "_c_card", "trans_date", "_cap_from", "_cap_to", how="inner")
    t = t.filter(F.col("_bl_first") <= F.to_date("trans_date"))
    return t.select("trans_id", F.col("_p_passport").alias("passport_num"), F.col("_bl_first").alias("first_listed"))


@register(
    "asof_snapshot",
    with_views(
        "SELECT client_id, passport_num, phone, effective_from FROM clients_hist "
        "WHERE TIMESTAMP '2024-01-15 12:00:00' BETWEEN effective_from AND effective_to AND deleted_flg = 'N'"
    ),
)
def asof_snapshot(spark, d):
    """M-3: the client versions live at one instant."""
    from tallyhawk.operators.scd2 import scd2_as_of

    snap = scd2_as_of(V.clients_hist(spark, d), X.ts_lit("2024-01-15 12:00:00"))
    return snap.select("client_id", "passport_num", "phone", "effective_from")


@register(
    "current_dimension",
    with_views(
        "SELECT account_num, valid_to, client, effective_from FROM accounts_hist "
        "WHERE effective_to = TIMESTAMP '9999-12-31 00:00:00' AND deleted_flg = 'N'"
    ),
)
def current_dimension(spark, d):
    """P-7: open, not deleted versions (current state of the accounts)."""
    from tallyhawk.operators.scd2 import scd2_current

    return scd2_current(V.accounts_hist(spark, d)).select("account_num", "valid_to", "client", "effective_from")


REPORT_DAY = "2024-01-15"


@register(
    "fraud_report_daily",
    with_views(f"SELECT * FROM ({FRAUD_UNION}) u WHERE report_dt = DATE '{REPORT_DAY}'", FRAUD_EXTRA),
)
def fraud_report_daily(spark, d):
    """O-4 daily mode: the report of one day; the fact is read from one rule
    window before the day, the result equals that day of the full report."""
    return R.fraud_report(
        V.tx(spark, d), dims(spark, d), V.terminals_hist(spark, d), V.blacklist(spark, d),
        report_days=(REPORT_DAY, REPORT_DAY), probe_window_seconds=WIDE_PROBE_SECONDS,
    )
