"""Loads, watermarks, load state and constraint checks (FIXTURES.md 2.7)."""

import datetime as dt
from decimal import Decimal

import builders as B
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.operators import facts as L
from tallyhawk.operators import quality as Q
from tallyhawk.operators import state as ST
from tallyhawk.sources import files as FS


def test_amount_decimal_comma(spark):
    df = spark.createDataFrame([("5000,50",), ("5000",), ("0,05",)], "a string")
    assert [r[0] for r in df.select(X.normalize_amount("a")).collect()] == [Decimal("5000.50"), Decimal("5000.00"), Decimal("0.05")]


def test_csv_transactions(spark, workdir):
    p = f"{workdir}/transactions_01032024.txt"
    with open(p, "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n")
        f.write("1;2024-03-01 10:00:00.1234;5000,50;C1   ;PAYMENT;SUCCESS;T1\n")
    r = FS.read_transactions_csv(spark, p).first()
    assert r["amt"] == Decimal("5000.50") and r["card_num"] == "C1"
    assert r["trans_date"] == dt.datetime(2024, 3, 1, 10, 0, 0, 123000)


def _tx(spark, rows):
    return B.tx(spark, [(i, t, 10, "C", "SUCCESS", "T") for i, t in rows])


def test_transaction_dedupe(spark):
    existing = _tx(spark, [("1", "2024-03-01 10:00:00")])
    delta = _tx(spark, [("1", "2024-03-01 10:00:00"), ("1", "2024-03-01 11:00:00"), ("2", "2024-03-01 12:00:00"),
                        ("2", "2024-03-01 12:00:00")])
    got = sorted((r["trans_id"], r["trans_date"].hour, str(r["file_date"])) for r in L.load_transactions(existing, delta, "2024-03-01").collect())
    assert got == [("1", 11, "2024-03-01"), ("2", 12, "2024-03-01")]


def test_transaction_load_prunes_existing_to_the_files_days(spark):
    existing = _tx(spark, [("1", "2024-03-01 10:00:00"), ("9", "2023-01-01 10:00:00")])
    delta = _tx(spark, [("1", "2024-03-01 10:00:00"), ("3", "2024-03-01 11:00:00")])
    out = L.load_transactions(existing, delta, "2024-03-01")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-03-01" in plan or "2024-03-02" in plan
    assert [r["trans_id"] for r in out.collect()] == ["3"]


def test_blacklist_slice_and_first_listing_wins(spark):
    mtd = spark.createDataFrame(
        [("2024-03-09", "A"), ("2024-03-10", "B"), ("2024-03-10", "C"), ("2024-03-10", "C")], "date string, passport_num string"
    ).withColumn("date", F.col("date").cast("date"))
    existing = spark.createDataFrame([("C",)], "passport_num string")
    out = L.load_blacklist(existing, mtd, "2024-03-10", "2024-03-10 23:00:00").collect()
    assert [(r["passport_num"], str(r["entry_dt"]), str(r["file_date"])) for r in out] == [("B", "2024-03-10", "2024-03-10")]
    assert out[0]["processed_dt"] == dt.datetime(2024, 3, 10, 23)
    since = L.slice_accumulating(mtd, "date", "2024-03-10", since="2024-03-08")
    assert since.count() == 4


def _changes(spark, rows):
    df = spark.createDataFrame(rows, "create_dt string, update_dt string")
    return df.select(F.col("create_dt").cast("timestamp_ntz").alias("create_dt"), F.col("update_dt").cast("timestamp_ntz").alias("update_dt"))


def test_watermark_uses_create_when_not_updated(spark):
    meta = spark.createDataFrame([("source", "clients", "2024-01-01 00:00:00")], "schema_name string, table_name string, w string")
    meta = meta.select("schema_name", "table_name", F.col("w").cast("timestamp_ntz").alias("max_update_dt"))
    ch = _changes(spark, [("2024-01-05 00:00:00", None), ("2023-12-01 00:00:00", "2024-01-03 00:00:00")])
    out = {r["table_name"]: r["max_update_dt"] for r in ST.advance_watermark(meta, {"clients": ch}).collect()}
    assert out == {"clients": dt.datetime(2024, 1, 5)}


def test_watermarks_move_independently_and_never_back(spark):
    meta = spark.createDataFrame(
        [("source", "x", "2024-01-01 00:00:00"), ("source", "y", "2024-06-01 00:00:00")], "schema_name string, table_name string, w string"
    ).select("schema_name", "table_name", F.col("w").cast("timestamp_ntz").alias("max_update_dt"))
    ch = {"x": _changes(spark, [("2024-02-01 00:00:00", None)]), "y": _changes(spark, [("2024-03-01 00:00:00", None)]),
          "z": _changes(spark, [("2024-04-01 00:00:00", None)])}
    out = {r["table_name"]: r["max_update_dt"] for r in ST.advance_watermark(meta, ch).collect()}
    assert out == {"x": dt.datetime(2024, 2, 1), "y": dt.datetime(2024, 6, 1), "z": dt.datetime(2024, 4, 1)}
    assert ST.watermark_lookup(ST.advance_watermark(meta, ch), "x") == dt.datetime(2024, 2, 1)
    assert ST.watermark_lookup(meta, "missing") is None


def test_incremental_filter_rereads_the_watermark_day(spark):
    src = _changes(spark, [("2024-01-05 00:00:00", None), ("2024-01-04 23:59:59", None), ("2023-01-01 00:00:00", "2024-01-05 08:00:00"),
                           ("2023-01-01 00:00:00", "2024-01-04 08:00:00")])
    got = ST.incremental_extract(src, "2024-01-05 10:00:00").count()
    assert got == 2


def test_file_date_order_is_chronological(spark):
    names = spark.createDataFrame([("transactions_01042024.txt",), ("transactions_31032024.txt",)], "name string")
    got = [str(r["date_point"]) for r in FS.file_dates(names).orderBy("date_point").collect()]
    assert got == ["2024-03-31", "2024-04-01"]


def test_date_point_state_and_ready_reports(spark):
    day = spark.createDataFrame([("2024-03-10",)], "d string").select(F.col("d").cast("date").alias("date_point"))
    pts = ST.date_point_rows(day, {"transactions_flg": 1}).unionByName(
        ST.date_point_rows(day, {"transactions_flg": 1, "passport_blacklist_flg": 1})
    )
    state = ST.latest_state(pts).first()
    assert (state["transactions_flg"], state["passport_blacklist_flg"], state["terminals_flg"]) == (1, 1, 0)
    files = spark.createDataFrame([], "date_point date, kind string")
    ready = ST.ready_reports(ST.latest_state(pts), files).first()
    assert (ready["run_rule_1"], ready["run_rule_2"], ready["run_rule_3"], ready["run_rule_4"]) == (True, True, False, True)


def test_constraint_checks(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", None), ("3", "toolong")], "k string, v string")
    assert [(r["k"], r["n_rows"]) for r in Q.duplicate_keys(df, "k").collect()] == [("1", 2)]
    assert [(r["column_name"], r["n_nulls"]) for r in Q.null_violations(df, ["k", "v"]).collect()] == [("v", 1)]
    assert [r["k"] for r in Q.too_long(df, {"v": 3}).collect()] == ["3"]
    parent = spark.createDataFrame([("1",), ("2",)], "id string")
    assert [r["k"] for r in Q.orphans(df, parent, "k", "id").collect()] == ["3"]
    hist = spark.createDataFrame(
        [("a", "2024-01-01", "2024-01-10"), ("a", "2024-01-05", "9999-12-31"), ("b", "2024-01-01", "2024-01-02"),
         ("b", "2024-01-05", "9999-12-31"), ("c", "2024-01-05", "2024-01-01")],
        "k string, effective_from string, effective_to string",
    ).select("k", F.col("effective_from").cast("date").alias("effective_from"), F.col("effective_to").cast("date").alias("effective_to"))
    got = sorted((r["k"], r["issue"]) for r in Q.validity_violations(hist, "k", grain="day").collect())
    assert got == [("a", "overlap"), ("b", "gap"), ("c", "inverted")]
