"""Small DataFrame builders for golden tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tallyhawk.operators.rules import Dimensions

INF_TS = "9999-12-31 00:00:00"
TS0 = "2023-01-01 00:00:00"

TX_SCHEMA = "trans_id string, trans_date string, amt string, card_num string, oper_type string, oper_result string, terminal string"


def tx(spark, rows):
    """rows: (trans_id, 'YYYY-MM-DD hh:mm:ss[.fff]', amount, card, result, terminal)."""
    data = [(i, t, str(a), c, "PAYMENT", r, term) for i, t, a, c, r, term in rows]
    df = spark.createDataFrame(data, TX_SCHEMA)
    return df.select(
        "trans_id",
        F.col("trans_date").cast("timestamp_ntz").alias("trans_date"),
        F.col("amt").cast("decimal(18,2)").alias("amt"),
        "card_num", "oper_type", "oper_result", "terminal",
    )


def _ts(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def cards(spark, rows):
    """rows: (card_num, account_num, from, to, flag)."""
    df = spark.createDataFrame(rows, "card_num string, account_num string, effective_from string, effective_to string, deleted_flg string")
    return _ts(df, "effective_from", "effective_to")


def accounts(spark, rows):
    """rows: (account_num, valid_to 'YYYY-MM-DD', client, from, to, flag)."""
    df = spark.createDataFrame(rows, "account_num string, valid_to string, client string, effective_from string, effective_to string, deleted_flg string")
    return _ts(df.withColumn("valid_to", F.col("valid_to").cast("date")), "effective_from", "effective_to")


def clients(spark, rows):
    """rows: (client_id, last, first, patronymic, passport, valid_to, phone, from, to, flag)."""
    df = spark.createDataFrame(
        rows,
        "client_id string, last_name string, first_name string, patronymic string, passport_num string, "
        "passport_valid_to string, phone string, effective_from string, effective_to string, deleted_flg string",
    )
    return _ts(df.withColumn("passport_valid_to", F.col("passport_valid_to").cast("date")), "effective_from", "effective_to")


def terminals(spark, rows):
    """rows: (terminal_id, city, from 'YYYY-MM-DD', to, flag, file_date)."""
    df = spark.createDataFrame(rows, "terminal_id string, terminal_city string, effective_from string, effective_to string, deleted_flg string, file_date string")
    for c in ("effective_from", "effective_to", "file_date"):
        df = df.withColumn(c, F.col(c).cast("date"))
    return df.withColumn("terminal_type", F.lit("ATM")).withColumn("terminal_address", F.lit("x"))


def blacklist(spark, rows):
    """rows: (passport_num, entry_dt)."""
    df = spark.createDataFrame(rows, "passport_num string, entry_dt string")
    return df.withColumn("entry_dt", F.col("entry_dt").cast("date"))


def simple_dims(spark, people):
    """people: (card/account/client id, passport, passport_valid_to, contract_valid_to)."""
    c = cards(spark, [(k, k, TS0, INF_TS, "N") for k, *_ in people])
    a = accounts(spark, [(k, cv, k, TS0, INF_TS, "N") for k, _, _, cv in people])
    p = clients(spark, [(k, "Last", "First", "Middle", pp, pv, "+" + k, TS0, INF_TS, "N") for k, pp, pv, _ in people])
    return Dimensions(cards=c, accounts=a, clients=p)


def dec(x):
    return Decimal(str(x))
