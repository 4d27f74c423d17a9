"""SQL twins of :mod:`tallyhawk.plans.views` for the DuckDB oracle.

``with_views(body)`` prefixes a query with the common table expressions it
needs; the driver tables are registered as views by the caller.
"""

from __future__ import annotations

import re

VIEWS = {
    "tx": """
SELECT CAST(event_id AS VARCHAR) AS trans_id,
       ts AS trans_date,
       CAST(value AS DECIMAL(18,2)) AS amt,
       CAST(user_id AS VARCHAR) AS card_num,
       event_type AS oper_type,
       CASE WHEN event_type IN ('error', 'view') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       regexp_extract(props, '[0-9]+', 0) AS terminal
FROM events""",
    "tx_close": """
SELECT CAST(event_id AS VARCHAR) AS trans_id,
       date_trunc('month', ts) + to_minutes(day(ts)) + to_seconds(hour(ts)) AS trans_date,
       CAST(value AS DECIMAL(18,2)) AS amt,
       CAST(user_id AS VARCHAR) AS card_num,
       event_type AS oper_type,
       CASE WHEN event_type IN ('error', 'view') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
       regexp_extract(props, '[0-9]+', 0) AS terminal
FROM events""",
    "clients_hist": """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS last_name, c_mktsegment AS first_name,
       'N' || CAST(c_nationkey AS VARCHAR) AS patronymic,
       DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS date_of_birth,
       'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
       CASE WHEN c_custkey % 11 = 0 THEN DATE '9999-12-31'
            ELSE DATE '2024-01-01' + CAST(c_custkey * 7 % 90 AS INTEGER) END AS passport_valid_to,
       CAST(c_custkey AS VARCHAR) AS phone,
       TIMESTAMP '2023-01-01 00:00:00' AS effective_from,
       CASE WHEN c_mktsegment = 'AUTOMOBILE'
            THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER))
                 + to_hours(CAST(c_custkey % 24 AS BIGINT)) - INTERVAL 1 MILLISECOND
            ELSE TIMESTAMP '9999-12-31 00:00:00' END AS effective_to,
       'N' AS deleted_flg
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment,
       'N' || CAST(c_nationkey AS VARCHAR),
       DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER),
       'Q' || CAST(c_custkey AS VARCHAR),
       DATE '2024-01-01' + CAST(c_custkey * 3 % 60 AS INTEGER),
       '+' || CAST(c_custkey AS VARCHAR),
       TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER))
           + to_hours(CAST(c_custkey % 24 AS BIGINT)),
       TIMESTAMP '9999-12-31 00:00:00',
       'N'
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""",
    "accounts_hist": """
SELECT CAST(c_custkey AS VARCHAR) AS account_num,
       DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS valid_to,
       CAST(c_custkey AS VARCHAR) AS client,
       TIMESTAMP '2023-01-01 00:00:00' AS effective_from,
       CASE WHEN c_acctbal > 9000
            THEN TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER)) - INTERVAL 1 MILLISECOND
            ELSE TIMESTAMP '9999-12-31 00:00:00' END AS effective_to,
       'N' AS deleted_flg
FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER), CAST(c_custkey AS VARCHAR),
       TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER)),
       TIMESTAMP '9999-12-31 00:00:00', 'Y'
FROM customer WHERE c_acctbal > 9000""",
    "cards_hist": """
SELECT CAST(c_custkey AS VARCHAR) AS card_num, CAST(c_custkey AS VARCHAR) AS account_num,
       TIMESTAMP '2023-01-01 00:00:00' AS effective_from, TIMESTAMP '9999-12-31 00:00:00' AS effective_to,
       'N' AS deleted_flg
FROM customer""",
    "blacklist": """
SELECT DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS entry_dt,
       'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
       DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS file_date
FROM customer WHERE c_acctbal < 0""",
    "terminal_ids": """
SELECT terminal_id, CAST(terminal_id AS INTEGER) AS tk
FROM (SELECT DISTINCT regexp_extract(props, '[0-9]+', 0) AS terminal_id FROM events)""",
    "terminal_base": """
SELECT i.terminal_id, i.tk,
       CASE WHEN i.tk % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
       'street ' || i.terminal_id AS terminal_address,
       n1.n_name AS city1, n1.n_regionkey AS region1, n2.n_name AS city2
FROM terminal_ids i
JOIN nation n1 ON n1.n_nationkey = i.tk % 25
JOIN nation n2 ON n2.n_nationkey = (i.tk + 1) % 25""",
    "terminals_hist": """
SELECT terminal_id, terminal_type, city1 AS terminal_city, terminal_address,
       DATE '2023-01-01' AS effective_from,
       CASE WHEN region1 = 0 THEN DATE '2024-01-14' ELSE DATE '9999-12-31' END AS effective_to,
       'N' AS deleted_flg, DATE '2023-01-01' AS file_date
FROM terminal_base
UNION ALL
SELECT terminal_id, terminal_type, city2, terminal_address,
       DATE '2024-01-15', DATE '9999-12-31', 'N', DATE '2024-01-15'
FROM terminal_base WHERE region1 = 0""",
    "terminals_a": """
SELECT terminal_id, terminal_type, city1 AS terminal_city, terminal_address
FROM terminal_base WHERE region1 <> 4""",
    "terminals_b": """
SELECT terminal_id, terminal_type, CASE WHEN region1 = 2 THEN city2 ELSE city1 END AS terminal_city, terminal_address
FROM terminal_base WHERE region1 <> 3""",
    "status_a": """
SELECT o_custkey AS cust_key, o_orderpriority AS priority,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
       o_orderdate AS changed_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders
      WHERE o_custkey % 10 <> 3 AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
WHERE rn = 1""",
    "status_b": """
SELECT o_custkey AS cust_key, o_orderpriority AS priority,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_custkey % 10 = 3 THEN greatest(o_orderdate, TIMESTAMP '1998-01-01 00:00:00') ELSE o_orderdate END AS changed_at
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders
      WHERE o_custkey % 10 <> 7)
WHERE rn = 1""",
    "versions": """
SELECT o_custkey AS cust_key, o_orderkey AS order_key, o_orderpriority AS priority, o_orderdate AS effective_from
FROM orders""",
    "clients_src": """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS last_name, c_mktsegment AS first_name,
       'N' || CAST(c_nationkey AS VARCHAR) AS patronymic,
       DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS date_of_birth,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Q' ELSE 'P' END || CAST(c_custkey AS VARCHAR) AS passport_num,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN DATE '2024-01-01' + CAST(c_custkey * 3 % 60 AS INTEGER)
            WHEN c_custkey % 11 = 0 THEN NULL
            ELSE DATE '2024-01-01' + CAST(c_custkey * 7 % 90 AS INTEGER) END AS passport_valid_to,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '+' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS phone,
       TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS create_dt,
       CASE WHEN c_mktsegment = 'AUTOMOBILE'
            THEN TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER)) + to_hours(CAST(c_custkey % 24 AS BIGINT))
            END AS update_dt
FROM customer""",
    "orders_src": """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderpriority AS priority, o_orderstatus AS status,
       o_orderdate AS create_dt,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS update_dt
FROM orders""",
}

# views that other views read
_DEPENDS = {
    "terminal_base": ["terminal_ids"],
    "terminals_hist": ["terminal_base"],
    "terminals_a": ["terminal_base"],
    "terminals_b": ["terminal_base"],
}


def _needed(body: str) -> list[str]:
    out: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPENDS.get(name, []):
            add(dep)
        if name not in out:
            out.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", body):
            add(name)
    return out


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs of every view it names (plus ``extra``
    query-specific CTEs, which may themselves use views)."""
    extra = extra or []
    text = body + " ".join(sql for _, sql in extra)
    names = _needed(text)
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in names] + [f"{n} AS ({sql}\n)" for n, sql in extra]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
