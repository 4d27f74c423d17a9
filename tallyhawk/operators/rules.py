"""Fraud rules and the accumulated report.

Inputs are warehouse tables:

* ``tx``        trans_id, trans_date (timestamp_ntz), amt, card_num, oper_type,
                oper_result, terminal
* ``cards``     card_num, account_num + validity columns
* ``accounts``  account_num, valid_to, client + validity columns
* ``clients``   client_id, last_name, first_name, patronymic, passport_num,
                passport_valid_to, phone + validity columns
* ``terminals`` terminal_id, terminal_city, ... + DATE validity + file_date
* ``blacklist`` passport_num, entry_dt

Validity columns are effective_from / effective_to / deleted_flg.  Every
dimension is joined as of ``trans_date`` and only live versions count, so a
transaction yields at most one report row per rule.

``report_days=None`` evaluates every day present in ``tx`` (backfill); a
``(first, last)`` pair restricts the report to those days and prunes the scan
to the rows that can matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C
from tallyhawk.operators import horizon as H
from tallyhawk.operators.asof import asof_join, intersect_versions, live_versions, uncovered_parts


@dataclass
class Dimensions:
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame


# --------------------------------------------------------------------------
# dimension-side preparation (dimension sized, never fact sized)


def _cards(dims: Dimensions) -> DataFrame:
    return live_versions(dims.cards).select(
        F.col("card_num").alias("_c_card"),
        F.col("account_num").alias("_c_account"),
        F.col(C.FROM_COL).alias("_c_from"),
        F.col(C.TO_COL).alias("_c_to"),
    )


def _accounts(dims: Dimensions) -> DataFrame:
    return live_versions(dims.accounts).select(
        F.col("account_num").alias("_a_account"),
        F.col("valid_to").alias("_a_valid_to"),
        F.col("client").alias("_a_client"),
        F.col(C.FROM_COL).alias("_a_from"),
        F.col(C.TO_COL).alias("_a_to"),
    )


def _clients(dims: Dimensions) -> DataFrame:
    return live_versions(dims.clients).select(
        F.col("client_id").alias("_p_client"),
        F.col("passport_num").alias("_p_passport"),
        X.fio().alias("_p_fio"),
        F.col("phone").alias("_p_phone"),
        F.col("passport_valid_to").alias("_p_passport_valid_to"),
        F.col(C.FROM_COL).alias("_p_from"),
        F.col(C.TO_COL).alias("_p_to"),
    )


def card_accounts(dims: Dimensions) -> DataFrame:
    """Live card versions x live account versions, intersected in time."""
    return intersect_versions(
        _cards(dims), _accounts(dims), "_c_account", "_a_account",
        "_c_from", "_c_to", "_a_from", "_a_to", "_ca_from", "_ca_to",
    )


def card_account_clients(dims: Dimensions) -> DataFrame:
    """Live card -> account -> client chain, intersected in time (inner)."""
    return intersect_versions(
        card_accounts(dims), _clients(dims), "_a_client", "_p_client",
        "_ca_from", "_ca_to", "_p_from", "_p_to", "_cap_from", "_cap_to",
    )


def first_listing(blacklist: DataFrame) -> DataFrame:
    """Earliest entry date per passport (map-side partial aggregation)."""
    return blacklist.groupBy(F.col("passport_num").alias("_bl_passport")).agg(
        F.min("entry_dt").alias("_bl_first")
    )


def _overlaps(versions: DataFrame, report_days, days_before: int = 0) -> DataFrame:
    """Versions that overlap the report days (and some days before them): an
    operation outside can't be reported, so the scans skip the others."""
    if report_days is None:
        return versions
    first, last = (F.lit(str(d)).cast("date") for d in report_days)
    return versions.filter((F.col(C.TO_COL) >= F.date_sub(first, days_before)) & (F.col(C.FROM_COL) < F.date_add(last, 1)))


def dimensions_in_days(dims: Dimensions, report_days) -> Dimensions:
    """The versions that an operation of the report days can meet."""
    return Dimensions(*[_overlaps(d, report_days) for d in (dims.cards, dims.accounts, dims.clients)])


# --------------------------------------------------------------------------
# enrichment


def enrichment_levels(dims: Dimensions) -> DataFrame:
    """The card -> account -> client chain with left-join semantics, pre-joined
    on the dimension side into time-disjoint pieces per card:

    * level 3: card, account and client versions all live;
    * level 2: card and account live, no live client (person NULL);
    * level 1: card live, no live account (account and person NULL).

    Each instant of a live card version lies in exactly one piece, so one
    as-of join of the fact with this table equals the chain of three left
    as-of joins, with one fact shuffle instead of three.
    """
    person = ["_p_passport", "_p_fio", "_p_phone", "_p_passport_valid_to"]
    nulls = {"_a_valid_to": "date", "_a_client": "string", "_p_passport": "string", "_p_fio": "string",
             "_p_phone": "string", "_p_passport_valid_to": "date"}

    def none(c):
        return F.lit(None).cast(nulls[c]).alias(c)

    l3 = card_account_clients(dims).select(
        "_c_card", F.col("_cap_from").alias("_l_from"), F.col("_cap_to").alias("_l_to"), "_a_valid_to", "_a_client", *person
    )
    ca = card_accounts(dims)
    l2 = uncovered_parts(ca, _clients(dims), ["_c_card", "_ca_from"], "_a_client", "_p_client", "_ca_from", "_ca_to", "_p_from", "_p_to")
    l2 = l2.select("_c_card", F.col("_ca_from").alias("_l_from"), F.col("_ca_to").alias("_l_to"), "_a_valid_to", "_a_client",
                   *[none(c) for c in person])
    l1 = uncovered_parts(_cards(dims), _accounts(dims), ["_c_card", "_c_from"], "_c_account", "_a_account", "_c_from", "_c_to", "_a_from", "_a_to")
    l1 = l1.select("_c_card", F.col("_c_from").alias("_l_from"), F.col("_c_to").alias("_l_to"),
                   *[none(c) for c in ["_a_valid_to", "_a_client", *person]])
    return l3.unionByName(l2).unionByName(l1)


def enrich_transactions(tx: DataFrame, dims: Dimensions, how: str = "left") -> DataFrame:
    """Attach the card, account and client versions valid at ``trans_date``.

    ``how='left'`` keeps every transaction (person/account columns NULL where
    a link has no live version); ``how='inner'`` keeps only transactions with
    the whole chain.  Either way the fact is joined once, to a pre-joined
    dimension table.  Adds ``_a_valid_to``, ``_a_client`` and the ``_p_*``
    person columns.
    """
    if how == "inner":
        chain = card_account_clients(dims).withColumnRenamed("_cap_from", "_l_from").withColumnRenamed("_cap_to", "_l_to")
    else:
        chain = enrichment_levels(dims)
    t = asof_join(tx, chain, "card_num", "_c_card", "trans_date", "_l_from", "_l_to", how=how)
    return t.drop("_c_card", "_l_from", "_l_to")


def enrich_transactions_chain(tx: DataFrame, dims: Dimensions, how: str = "left") -> DataFrame:
    """The same enrichment as three successive as-of joins (plain form;
    shuffles the fact once per link).  Kept for checks."""
    t = asof_join(tx, _cards(dims), "card_num", "_c_card", "trans_date", "_c_from", "_c_to", how=how)
    t = asof_join(t, _accounts(dims), "_c_account", "_a_account", "trans_date", "_a_from", "_a_to", how=how)
    t = asof_join(t, _clients(dims), "_a_client", "_p_client", "trans_date", "_p_from", "_p_to", how=how)
    return t


def to_report(df: DataFrame, event_type: int) -> DataFrame:
    """Project enriched rows onto the report columns."""
    return df.select(
        F.col("trans_date").alias("event_dt"),
        F.col("_p_passport").alias("passport"),
        F.col("_p_fio").alias("fio"),
        F.col("_p_phone").alias("phone"),
        F.lit(event_type).cast("int").alias("event_type"),
        F.to_date("trans_date").alias("report_dt"),
    )


def _tx_keys(tx: DataFrame, report_days) -> DataFrame:
    t = tx.select("trans_id", "trans_date", "card_num")
    if report_days is not None:
        t = t.filter(H.in_report_days("trans_date", report_days))
    return t


# --------------------------------------------------------------------------
# rule 1: expired or blacklisted passport


def rule_passport(tx: DataFrame, dims: Dimensions, blacklist: DataFrame, report_days=None) -> DataFrame:
    """Operation while the client's passport (version valid at the operation)
    had expired before that day or was blacklisted on or before that day.

    The fact is joined once, to the pre-joined card/account/client chain that
    already carries the first blacklisting date of each passport.
    """
    chain = card_account_clients(dimensions_in_days(dims, report_days))
    chain = chain.join(first_listing(blacklist), F.col("_p_passport") == F.col("_bl_passport"), "left")
    t = asof_join(_tx_keys(tx, report_days), chain, "card_num", "_c_card", "trans_date", "_cap_from", "_cap_to", how="inner")
    day = F.to_date("trans_date")
    hit = (F.col("_p_passport_valid_to") < day) | (F.col("_bl_first") <= day)
    return to_report(t.filter(hit), C.EVENT_PASSPORT)


# --------------------------------------------------------------------------
# rule 2: expired contract


def rule_contract(tx: DataFrame, dims: Dimensions, report_days=None) -> DataFrame:
    """Operation on an account whose contract ended before the operation day.

    The account must have a live version at the operation; the client is
    optional (person columns NULL when unknown).  Only the hits are joined
    to the clients.
    """
    dims = dimensions_in_days(dims, report_days)
    t = asof_join(_tx_keys(tx, report_days), card_accounts(dims), "card_num", "_c_card", "trans_date", "_ca_from", "_ca_to", how="inner")
    hits = t.filter(F.col("_a_valid_to") < F.to_date("trans_date"))
    hits = asof_join(hits, _clients(dims), "_a_client", "_p_client", "trans_date", "_p_from", "_p_to", how="left")
    return to_report(hits, C.EVENT_CONTRACT)


# --------------------------------------------------------------------------
# rule 3: different cities within one hour


def resolve_terminal_city(tx: DataFrame, terminals: DataFrame) -> DataFrame:
    """Operations whose terminal has a live version on the operation day.

    Terminal versions are DATE grain; versions loaded after the day
    (``file_date``) are ignored.
    """
    term = live_versions(terminals).select(
        F.col("terminal_id").alias("_t_id"),
        F.col("terminal_city").alias("city"),
        F.col(C.FROM_COL).alias("_t_from"),
        F.col(C.TO_COL).alias("_t_to"),
        F.col(C.FILE_DATE_COL).alias("_t_file_date"),
    )
    cond = (
        (F.col("terminal") == F.col("_t_id"))
        & X.valid_at("trans_date", "_t_from", "_t_to", grain="day")
        & (F.col("_t_file_date") <= F.to_date("trans_date"))
    )
    return tx.join(term, cond, "inner").drop("_t_id", "_t_from", "_t_to", "_t_file_date")


def city_hop_hits(
    tx: DataFrame,
    terminals: DataFrame,
    report_days=None,
    window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Operations whose previous operation of the same card (among those with
    a known terminal city) was at most ``window_seconds`` earlier in another
    city.  Returns trans_id, trans_date, card_num of the second operation."""
    raw = H.report_day_bounds(tx.select("trans_id", "trans_date", "card_num", "terminal"), "trans_date", report_days, window_seconds)
    terminals = _overlaps(terminals, report_days, -(-window_seconds // 86400))
    t = resolve_terminal_city(raw.where("card_num is not null"), terminals)  # unknown cards are not one card
    t = H.with_horizon_buckets(t, "trans_date", window_seconds, bucket_seconds)
    w = H.bucket_window("card_num", "trans_date", "trans_id")
    prev_ts = F.lag("trans_date").over(w)
    prev_city = F.lag("city").over(w)
    t = t.withColumn("_prev_ts", prev_ts).withColumn("_prev_city", prev_city)
    hit = (
        F.col(H.HOME)
        & (F.col("_prev_ts") >= F.col("trans_date") - F.expr(f"INTERVAL '{int(window_seconds)}' SECOND"))
        & (F.col("city") != F.col("_prev_city"))
        & H.in_report_days("trans_date", report_days)
    )
    return t.filter(hit).select("trans_id", "trans_date", "card_num")


def rule_city_hop(
    tx: DataFrame,
    terminals: DataFrame,
    dims: Dimensions,
    report_days=None,
    window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    bucket_seconds: int | None = None,
) -> DataFrame:
    hits = city_hop_hits(tx, terminals, report_days, window_seconds, bucket_seconds)
    dims = dimensions_in_days(dims, report_days)
    return to_report(enrich_transactions(hits, dims, how="left"), C.EVENT_CITY_HOP)


# --------------------------------------------------------------------------
# rule 4: amount probing


def amount_probe_hits(
    tx: DataFrame,
    report_days=None,
    window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
    rejects: int = C.AMOUNT_PROBE_REJECTS,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """A successful operation preceded by ``rejects`` rejected operations of
    the same card, amounts strictly falling along the chain, and the first of
    them at most ``window_seconds`` earlier.  The success is reported."""
    t = H.report_day_bounds(
        tx.select("trans_id", "trans_date", "card_num", "amt", "oper_result").where("card_num is not null"),
        "trans_date", report_days, window_seconds,
    )
    t = H.with_horizon_buckets(t, "trans_date", window_seconds, bucket_seconds)
    w = H.bucket_window("card_num", "trans_date", "trans_id")
    for k in range(1, rejects + 1):
        t = t.withColumn(f"_res{k}", F.lag("oper_result", k).over(w)).withColumn(f"_amt{k}", F.lag("amt", k).over(w))
    t = t.withColumn("_ts_first", F.lag("trans_date", rejects).over(w))
    cond = F.col(H.HOME) & (F.col("oper_result") == C.SUCCESS)
    cond = cond & (F.col("_ts_first") >= F.col("trans_date") - F.expr(f"INTERVAL '{int(window_seconds)}' SECOND"))
    prev_amt = F.col("amt")
    for k in range(1, rejects + 1):
        cond = cond & (F.col(f"_res{k}") == C.REJECT) & (F.col(f"_amt{k}") > prev_amt)
        prev_amt = F.col(f"_amt{k}")
    cond = cond & H.in_report_days("trans_date", report_days)
    return t.filter(cond).select("trans_id", "trans_date", "card_num")


def rule_amount_probe(
    tx: DataFrame,
    dims: Dimensions,
    report_days=None,
    window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
    rejects: int = C.AMOUNT_PROBE_REJECTS,
    bucket_seconds: int | None = None,
) -> DataFrame:
    hits = amount_probe_hits(tx, report_days, window_seconds, rejects, bucket_seconds)
    dims = dimensions_in_days(dims, report_days)
    return to_report(enrich_transactions(hits, dims, how="left"), C.EVENT_AMOUNT_PROBE)


# --------------------------------------------------------------------------
# fused evaluation for the report: one fact join for rules 1+2, one window
# pass for rules 3+4


def passport_contract_hits(tx: DataFrame, dims: Dimensions, blacklist: DataFrame, report_days=None, rules=(1, 2)) -> DataFrame:
    """Rules 1 and 2 with a single as-of join of the fact.

    The dimension side is the union of the card/account chain (rule 2) and
    the card/account/client chain with first blacklisting dates (rule 1),
    both dimension sized; every transaction matches at most one row of each.
    Returns enriched hits with an ``event_type`` column.
    """
    parts = []
    if 2 in rules:
        ca = card_accounts(dims)
        parts.append(ca.select(
            F.lit(C.EVENT_CONTRACT).alias("event_type"), "_c_card", F.col("_ca_from").alias("_u_from"),
            F.col("_ca_to").alias("_u_to"), "_a_valid_to", "_a_client",
            F.lit(None).cast("string").alias("_p_passport"), F.lit(None).cast("string").alias("_p_fio"),
            F.lit(None).cast("string").alias("_p_phone"), F.lit(None).cast("date").alias("_p_passport_valid_to"),
            F.lit(None).cast("date").alias("_bl_first"),
        ))
    if 1 in rules:
        cap = card_account_clients(dims).join(first_listing(blacklist), F.col("_p_passport") == F.col("_bl_passport"), "left")
        parts.append(cap.select(
            F.lit(C.EVENT_PASSPORT).alias("event_type"), "_c_card", F.col("_cap_from").alias("_u_from"),
            F.col("_cap_to").alias("_u_to"), "_a_valid_to", "_a_client", "_p_passport", "_p_fio", "_p_phone",
            "_p_passport_valid_to", "_bl_first",
        ))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    t = asof_join(_tx_keys(tx, report_days), u, "card_num", "_c_card", "trans_date", "_u_from", "_u_to", how="inner")
    day = F.to_date("trans_date")
    hit = ((F.col("event_type") == C.EVENT_PASSPORT) & ((F.col("_p_passport_valid_to") < day) | (F.col("_bl_first") <= day))) | (
        (F.col("event_type") == C.EVENT_CONTRACT) & (F.col("_a_valid_to") < day)
    )
    hits = t.filter(hit)
    # rule-2 hits take their (optional) client from the clients valid at the time
    cl = _clients(dims).select(
        F.col("_p_client").alias("_q_client"), F.col("_p_passport").alias("_q_passport"), F.col("_p_fio").alias("_q_fio"),
        F.col("_p_phone").alias("_q_phone"), F.col("_p_from").alias("_q_from"), F.col("_p_to").alias("_q_to"),
    )
    cond = (F.col("event_type") == C.EVENT_CONTRACT) & (F.col("_a_client") == F.col("_q_client")) & X.valid_at(
        "trans_date", "_q_from", "_q_to"
    )
    hits = hits.join(cl, cond, "left")
    return hits.select(
        "trans_id", "trans_date", "event_type",
        F.coalesce("_p_passport", "_q_passport").alias("_p_passport"),
        F.coalesce("_p_fio", "_q_fio").alias("_p_fio"),
        F.coalesce("_p_phone", "_q_phone").alias("_p_phone"),
    )


def sequence_hits(
    tx: DataFrame,
    terminals: DataFrame | None,
    report_days=None,
    city_window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    probe_window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
    rejects: int = C.AMOUNT_PROBE_REJECTS,
    rules=(3, 4),
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Rules 3 and 4 in one window pass over the card's operations.

    The terminal city is left-joined; rule 3's predecessor is the previous
    operation *with* a known city (running ``last(..., ignorenulls)``), which
    is the same sequence rule 3 sees when unknown terminals are dropped.
    Operations without a card are left out: unknown cards are not one card.
    Returns (trans_id, trans_date, card_num, event_type) per hit.
    """
    horizon = max(city_window_seconds if 3 in rules else 0, probe_window_seconds if 4 in rules else 0)
    t = H.report_day_bounds(
        tx.select("trans_id", "trans_date", "card_num", "terminal", "amt", "oper_result").where("card_num is not null"),
        "trans_date", report_days, horizon,
    )
    if 3 in rules:
        term = live_versions(_overlaps(terminals, report_days, -(-horizon // 86400))).select(
            F.col("terminal_id").alias("_t_id"), F.col("terminal_city").alias("_t_city"),
            F.col(C.FROM_COL).alias("_t_from"), F.col(C.TO_COL).alias("_t_to"), F.col(C.FILE_DATE_COL).alias("_t_file_date"),
        )
        cond = (
            (F.col("terminal") == F.col("_t_id"))
            & X.valid_at("trans_date", "_t_from", "_t_to", grain="day")
            & (F.col("_t_file_date") <= F.to_date("trans_date"))
        )
        t = t.join(term, cond, "left").select(*t.columns, F.col("_t_city").alias("city"))
    t = H.with_horizon_buckets(t, "trans_date", horizon, bucket_seconds)
    w = H.bucket_window("card_num", "trans_date", "trans_id")
    flags = []
    if 3 in rules:
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        prev = F.last(F.when(F.col("city").isNotNull(), F.struct(F.col("trans_date").alias("ts"), F.col("city").alias("city"))), ignorenulls=True).over(before)
        t = t.withColumn("_prev", prev)
        city_hit = (
            F.col("city").isNotNull()
            & (F.col("_prev.ts") >= F.col("trans_date") - F.expr(f"INTERVAL '{int(city_window_seconds)}' SECOND"))
            & (F.col("_prev.city") != F.col("city"))
        )
        flags.append(F.when(city_hit, F.lit(C.EVENT_CITY_HOP)))
    if 4 in rules:
        for k in range(1, rejects + 1):
            t = t.withColumn(f"_res{k}", F.lag("oper_result", k).over(w)).withColumn(f"_amt{k}", F.lag("amt", k).over(w))
        t = t.withColumn("_ts_first", F.lag("trans_date", rejects).over(w))
        probe = (F.col("oper_result") == C.SUCCESS) & (
            F.col("_ts_first") >= F.col("trans_date") - F.expr(f"INTERVAL '{int(probe_window_seconds)}' SECOND")
        )
        prev_amt = F.col("amt")
        for k in range(1, rejects + 1):
            probe = probe & (F.col(f"_res{k}") == C.REJECT) & (F.col(f"_amt{k}") > prev_amt)
            prev_amt = F.col(f"_amt{k}")
        flags.append(F.when(probe, F.lit(C.EVENT_AMOUNT_PROBE)))
    t = t.filter(F.col(H.HOME) & H.in_report_days("trans_date", report_days))
    t = t.select("trans_id", "trans_date", "card_num", F.explode(F.filter(F.array(*flags), lambda x: x.isNotNull())).alias("event_type"))
    return t


def to_report_typed(df: DataFrame) -> DataFrame:
    """Report projection of enriched rows carrying their own event_type."""
    return df.select(
        F.col("trans_date").alias("event_dt"),
        F.col("_p_passport").alias("passport"),
        F.col("_p_fio").alias("fio"),
        F.col("_p_phone").alias("phone"),
        F.col("event_type").cast("int").alias("event_type"),
        F.to_date("trans_date").alias("report_dt"),
    )


# --------------------------------------------------------------------------
# the report


def fraud_report(
    tx: DataFrame,
    dims: Dimensions,
    terminals: DataFrame,
    blacklist: DataFrame,
    report_days=None,
    rules=(1, 2, 3, 4),
    city_window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    probe_window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
    probe_rejects: int = C.AMOUNT_PROBE_REJECTS,
) -> DataFrame:
    """The selected rules in the report schema.

    Two passes over the fact: one as-of join for rules 1+2 and one
    (card, time bucket) window for rules 3+4, instead of one per rule.
    """
    parts = []
    dims = dimensions_in_days(dims, report_days)
    r12 = tuple(r for r in rules if r in (1, 2))
    r34 = tuple(r for r in rules if r in (3, 4))
    if r12:
        parts.append(to_report_typed(passport_contract_hits(tx, dims, blacklist, report_days, r12)))
    if r34:
        hits = sequence_hits(tx, terminals, report_days, city_window_seconds, probe_window_seconds, probe_rejects, r34)
        parts.append(to_report_typed(enrich_transactions(hits, dims, how="left")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fraud_report_by_rule(
    tx: DataFrame,
    dims: Dimensions,
    terminals: DataFrame,
    blacklist: DataFrame,
    report_days=None,
    city_window_seconds: int = C.CITY_HOP_WINDOW_SECONDS,
    probe_window_seconds: int = C.AMOUNT_PROBE_WINDOW_SECONDS,
    probe_rejects: int = C.AMOUNT_PROBE_REJECTS,
) -> DataFrame:
    """Plain evaluation: the four rule operators one by one (for checks)."""
    return (
        rule_passport(tx, dims, blacklist, report_days)
        .unionByName(rule_contract(tx, dims, report_days))
        .unionByName(rule_city_hop(tx, terminals, dims, report_days, city_window_seconds))
        .unionByName(rule_amount_probe(tx, dims, report_days, probe_window_seconds, probe_rejects))
    )


def report_summary(report: DataFrame) -> DataFrame:
    """Number of report rows per day and event type."""
    return report.groupBy("report_dt", "event_type").agg(F.count(F.lit(1)).alias("n_events"))


def event_types(spark, effective_from: str = "2023-01-01 00:00:00") -> DataFrame:
    """The event-type dimension (K-7): one live, open row per rule."""
    rows = [(t, d) for t, d in C.EVENT_TYPES]
    df = spark.createDataFrame(rows, "event_type int, description string")
    return df.select(
        "event_type", "description",
        X.ts_lit(effective_from).alias(C.FROM_COL), X.inf_ts().alias(C.TO_COL), F.lit(C.LIVE).alias(C.FLAG_COL),
    )
