"""End to end: JDBC incremental loads (embedded Derby, in-process), daily runs
over CSV files, idempotent reruns and the streamed file source."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from tallyhawk.plans import warehouse as P
from tallyhawk.sources import files as FS
from tallyhawk.sources import jdbc as J
from tallyhawk.streaming import file_stream as FST


# ------------------------------------------------------------------ helpers


def _derby(spark, folder):
    url = f"jdbc:derby:{folder}/srcdb;create=true"
    conn = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    return url.replace(";create=true", ""), conn


def _exec(conn, *sql):
    st = conn.createStatement()
    for s in sql:
        st.execute(s)
    st.close()


CLIENTS_DDL = (
    "CREATE TABLE clients (client_id VARCHAR(10), last_name VARCHAR(20), first_name VARCHAR(20), "
    "patronymic VARCHAR(20), date_of_birth DATE, passport_num VARCHAR(15), passport_valid_to DATE, "
    "phone CHAR(16), create_dt TIMESTAMP, update_dt TIMESTAMP)"
)
ACCOUNTS_DDL = "CREATE TABLE accounts (account CHAR(20), valid_to DATE, client VARCHAR(10), create_dt TIMESTAMP, update_dt TIMESTAMP)"
CARDS_DDL = "CREATE TABLE cards (card_num CHAR(20), account CHAR(20), create_dt TIMESTAMP, update_dt TIMESTAMP)"

PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _load_dims(spark, wh, url, run_ts):
    for t in ("clients", "accounts", "cards"):
        wm = P.source_watermark(wh, t)
        changed = J.read_changes(spark, url, t.upper(), wm, PROPS)
        changed = changed.toDF(*[c.lower() for c in changed.columns])
        keys = J.read_keys(spark, url, t.upper(), J_KEYS[t].upper(), PROPS)
        P.merge_source_table(wh, t, changed, keys, run_ts)


J_KEYS = {"clients": "client_id", "accounts": "account", "cards": "card_num"}


def _write_csv(path, header, rows):
    with open(path, "w") as f:
        f.write(";".join(header) + "\n")
        for r in rows:
            f.write(";".join("" if v is None else str(v) for v in r) + "\n")


TX_HEADER = ["transaction_id", "transaction_date", "amount", "card_num", "oper_type", "oper_result", "terminal"]
TERM_HEADER = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]


# ------------------------------------------------------------------ tests


def test_jdbc_incremental(spark, workdir):
    url, conn = _derby(spark, workdir)
    _exec(
        conn, CLIENTS_DDL, ACCOUNTS_DDL, CARDS_DDL,
        "INSERT INTO clients VALUES ('1', 'Ivanov', 'Ivan', 'I', '1980-01-01', 'P1', '2030-01-01', '+1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO clients VALUES ('2', 'Petrov', 'Petr', 'P', '1981-01-01', 'P2', NULL, '+2', '2024-01-01 11:00:00', NULL)",
        "INSERT INTO accounts VALUES ('A1', '2030-01-01', '1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO accounts VALUES ('A2', '2024-02-01', '2', '2024-01-01 11:00:00', NULL)",
        "INSERT INTO cards VALUES ('C1', 'A1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO cards VALUES ('C2', 'A2', '2024-01-01 11:00:00', NULL)",
    )
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    _load_dims(spark, wh, url, "2024-01-02 00:00:00")
    assert wh.history("clients").count() == 2
    # CHAR(20) keys are trimmed, NULL passport end becomes infinity
    assert sorted(r["account_num"] for r in wh.history("accounts").collect()) == ["A1", "A2"]
    assert wh.history("clients").filter(F.col("passport_valid_to") == F.lit("9999-12-31").cast("date")).count() == 1

    # the watermark predicate reaches the JDBC scan
    wm = P.source_watermark(wh, "clients")
    assert wm == dt.datetime(2024, 1, 1, 11, 0)
    plan = J.read_changes(spark, url, "CLIENTS", wm, PROPS)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "UPDATE_DT" in plan

    _exec(
        conn,
        "UPDATE clients SET phone = '+100', update_dt = '2024-01-05 09:00:00' WHERE client_id = '1'",
        "DELETE FROM cards WHERE card_num = 'C2'",
    )
    _load_dims(spark, wh, url, "2024-01-06 00:00:00")
    h = wh.history("clients")
    assert h.count() == 3
    assert h.filter((F.col("client_id") == "1") & (F.col("effective_to") == F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))).first()["phone"] == "+100"
    cards = wh.history("cards")
    assert sorted((r["card_num"], r["deleted_flg"]) for r in cards.collect()) == [("C1", "N"), ("C2", "N"), ("C2", "Y")]
    # rerunning the same load changes nothing
    _load_dims(spark, wh, url, "2024-01-06 00:00:00")
    assert wh.history("clients").count() == 3 and wh.history("cards").count() == 3
    conn.close()


def test_pipeline_e2e_and_report_rerun(spark, workdir):
    url, conn = _derby(spark, workdir)
    _exec(
        conn, CLIENTS_DDL, ACCOUNTS_DDL, CARDS_DDL,
        "INSERT INTO clients VALUES ('1', 'Ivanov', 'Ivan', 'I', '1980-01-01', 'P1', '2024-03-01', '+1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO accounts VALUES ('A1', '2024-03-01', '1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO cards VALUES ('C1', 'A1', '2024-01-01 10:00:00', NULL)",
    )
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    _load_dims(spark, wh, url, "2024-01-02 00:00:00")
    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    _write_csv(f"{drop}/transactions_10032024.txt", TX_HEADER, [
        ("t1", "2024-03-10 10:00:00", "100,50", "C1", "PAYMENT", "SUCCESS", "T1"),
        ("t2", "2024-03-10 10:30:00", "5000", "C1", "PAYMENT", "SUCCESS", "T2"),
        ("t2", "2024-03-10 10:30:00", "5000", "C1", "PAYMENT", "SUCCESS", "T2"),
    ])
    _write_csv(f"{drop}/terminals_10032024.txt", TERM_HEADER, [("T1", "ATM", "Moscow", "a"), ("T2", "ATM", "Kazan", "b")])
    _write_csv(f"{drop}/passport_blacklist_10032024.txt", ["date", "passport"], [("2024-03-09", "PX"), ("2024-03-10", "P1")])

    files = {
        "transactions": FS.read_transactions_csv(spark, f"{drop}/transactions_10032024.txt"),
        "terminals": FS.read_snapshot(spark, f"{drop}/terminals_10032024.txt"),
        "passport_blacklist": FS.read_accumulating(spark, f"{drop}/passport_blacklist_10032024.txt").withColumnRenamed(
            "passport", "passport_num"
        ),
    }
    flags = P.run_date(wh, "2024-03-10", "2024-03-10 23:00:00", files)
    assert flags["event_type_3_rep"] == 1
    fact = wh.read("fact", "transactions")
    assert fact.count() == 2
    assert sorted(str(r["amt"]) for r in fact.collect()) == ["100.50", "5000.00"]
    bl = wh.read("fact", "passport_blacklist")
    assert [r["passport_num"] for r in bl.collect()] == ["P1"]
    rep = wh.report()
    got = sorted((r["event_type"], r["event_dt"].strftime("%H:%M")) for r in rep.collect())
    # passport expired 03-01 and blacklisted: one row per operation; contract ended; city hop at 10:30
    assert got == [(1, "10:00"), (1, "10:30"), (2, "10:00"), (2, "10:30"), (3, "10:30")]

    # the daily report reads only the operation days it needs (partition pruning)
    rep_df, _ = P.report_frame(wh, ("2024-03-10", "2024-03-10"), [1, 2, 3, 4])
    plan = rep_df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trans_day" in plan

    # rerun of the day: flags prevent reloading, nothing is duplicated
    P.run_date(wh, "2024-03-10", "2024-03-11 01:00:00", files)
    assert wh.read("fact", "transactions").count() == 2
    assert wh.report().count() == 5
    # recomputing the rules rewrites the same report partitions
    P.run_rules(wh, ("2024-03-10", "2024-03-10"), [1, 2, 3, 4])
    assert wh.report().count() == 5
    # reloading the same file (e.g. after a crash before the state row) is idempotent
    P.load_transactions_file(wh, files["transactions"], "2024-03-10")
    assert wh.read("fact", "transactions").count() == 2
    conn.close()


def test_file_stream(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    drop, arch, cp = (os.path.join(workdir, n) for n in ("drop", "archive", "cp"))
    os.makedirs(drop)
    _write_csv(f"{drop}/transactions_01032024.txt", TX_HEADER, [
        ("a", "2024-03-01 10:00:00", "100", "C1", "PAYMENT", "REJECT", "T1"),
        ("b", "2024-03-01 10:05:00", "90", "C1", "PAYMENT", "REJECT", "T1"),
        ("c", "2024-03-01 10:10:00", "80", "C1", "PAYMENT", "REJECT", "T1"),
        ("d", "2024-03-01 10:15:00", "70,5", "C1", "PAYMENT", "SUCCESS", "T1"),
    ])
    FST.run_available(FST.transactions_stream(spark, drop, arch), P.transactions_batch_writer(wh, rules=(4,)), cp)
    assert wh.read("fact", "transactions").count() == 4
    rep = wh.report().collect()
    assert [(r["event_type"], r["event_dt"].strftime("%H:%M")) for r in rep] == [(4, "10:15")]

    # a second file: only it is processed; re-sent rows are not duplicated
    _write_csv(f"{drop}/transactions_02032024.txt", TX_HEADER, [
        ("d", "2024-03-01 10:15:00", "70,5", "C1", "PAYMENT", "SUCCESS", "T1"),
        ("e", "2024-03-02 09:00:00", "10", "C2", "PAYMENT", "SUCCESS", "T9"),
    ])
    FST.run_available(FST.transactions_stream(spark, drop, arch), P.transactions_batch_writer(wh, rules=(4,)), cp)
    fact = wh.read("fact", "transactions")
    assert sorted(r["trans_id"] for r in fact.collect()) == ["a", "b", "c", "d", "e"]
    assert sorted(r["load_id"] for r in fact.filter(F.col("trans_id") == "e").collect()) == ["transactions_02032024.txt"]
    pts = wh.read("meta", "date_points")
    assert sorted(str(r["date_point"]) for r in pts.collect()) == ["2024-03-01", "2024-03-02"]
    # processed files are moved to the archive by the source (one run late)
    FST.run_available(FST.transactions_stream(spark, drop, arch), P.transactions_batch_writer(wh, rules=(4,)), cp)
    archived = {f for _, _, fs in os.walk(arch) for f in fs}
    assert "transactions_01032024.txt" in archived
    assert "transactions_01032024.txt" not in os.listdir(drop)
    assert wh.read("fact", "transactions").count() == 5


def test_file_dates_from_names(spark):
    names = spark.createDataFrame(
        [("transactions_31032024.txt",), ("passport_blacklist_01042024.xlsx",), ("terminals_31032024.xlsx",), ("readme.txt",)],
        "name string",
    )
    got = [(str(r["date_point"]), r["n_files"]) for r in FS.file_dates(names).orderBy("date_point").collect()]
    assert got == [("2024-03-31", 2), ("2024-04-01", 1)]


def test_list_files(spark, workdir):
    for n in ("transactions_01032024.txt", "terminals_02032024.txt"):
        _write_csv(os.path.join(workdir, n), ["x"], [("1",)])
    got = sorted(str(r["date_point"]) for r in FS.discover_file_dates(spark, workdir).collect())
    assert got == ["2024-03-01", "2024-03-02"]


def test_jdbc_full(spark, workdir):
    url, conn = _derby(spark, workdir)
    _exec(conn, CARDS_DDL, *[f"INSERT INTO cards VALUES ('C{i}', 'A{i}', '2024-01-01 10:00:00', NULL)" for i in range(40)])
    _exec(conn, "ALTER TABLE cards ADD COLUMN n INT", "UPDATE cards SET n = CAST(SUBSTR(card_num, 2) AS INT)")
    df = J.read_table(spark, url, "CARDS", PROPS, partition_column="N", lower_bound=0, upper_bound=40, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40
    _exec(conn, "INSERT INTO cards VALUES ('CX', 'AX', '2024-01-01 10:00:00', NULL, NULL)")
    assert J.column_bounds(spark, url, "CARDS", "N", PROPS) == (0, 39)
    keys = J.read_keys(spark, url, "CARDS", "CARD_NUM", PROPS, partition_column="N", num_partitions=4)
    assert keys.columns == ["CARD_NUM"]
    assert keys.rdd.getNumPartitions() == 4 and keys.count() == 41
    _exec(conn, "DELETE FROM cards")
    assert J.read_changes(spark, url, "CARDS", None, PROPS, partition_column="N").count() == 0
    conn.close()


def test_terminal_snapshot(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    p1, p2 = os.path.join(workdir, "terminals_01032024.txt"), os.path.join(workdir, "terminals_05032024.txt")
    _write_csv(p1, TERM_HEADER, [("T1", "ATM", "Moscow", "a"), ("T2", "POS", "Kazan", "b")])
    _write_csv(p2, TERM_HEADER, [("T1", "ATM", "Omsk", "a"), ("T3", "ATM", "Perm", "c")])
    P.merge_terminals(wh, FS.read_snapshot(spark, p1), "2024-03-01")
    P.merge_terminals(wh, FS.read_snapshot(spark, p2), "2024-03-05")
    P.merge_terminals(wh, FS.read_snapshot(spark, p2), "2024-03-05")  # rerun: no change
    h = wh.history("terminals")
    got = sorted((r["terminal_id"], r["terminal_city"], str(r["effective_from"]), str(r["effective_to"]), r["deleted_flg"], str(r["file_date"]))
                 for r in h.collect())
    assert got == [
        ("T1", "Moscow", "2024-03-01", "2024-03-04", "N", "2024-03-01"),
        ("T1", "Omsk", "2024-03-05", "9999-12-31", "N", "2024-03-05"),
        ("T2", "Kazan", "2024-03-01", "2024-03-04", "N", "2024-03-01"),
        ("T2", "Kazan", "2024-03-05", "9999-12-31", "Y", "2024-03-05"),
        ("T3", "Perm", "2024-03-05", "9999-12-31", "N", "2024-03-05"),
    ]
    # only the open segment is read by the next merge
    assert wh.open_versions("terminals").count() == 3


def test_schemas(spark):
    src = spark.createDataFrame([("A1  ", "2030-01-01", "7", None, None)], "account string, valid_to string, client string, create_dt timestamp_ntz, update_dt timestamp_ntz")
    staged = P.stage_source(src, "accounts")
    assert staged.columns == ["account_num", "valid_to", "client", "create_dt", "update_dt"]
    assert staged.first()["account_num"] == "A1"
    assert P.KEYS == {"clients": "client_id", "accounts": "account_num", "cards": "card_num"}
    assert P.TRACKED["cards"] == ["account_num"]


def test_terminal_and_blacklist_streams(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    _write_csv(f"{drop}/terminals_01032024.txt", TERM_HEADER, [("T1", "ATM", "Moscow", "a"), ("T2", "POS", "Kazan", "b")])
    _write_csv(f"{drop}/terminals_05032024.txt", TERM_HEADER, [("T1", "ATM", "Omsk", "a")])
    FST.run_available(FST.terminals_stream(spark, drop), P.terminals_batch_writer(wh), os.path.join(workdir, "cp_t"))
    got = sorted((r["terminal_id"], r["terminal_city"], str(r["effective_from"]), str(r["effective_to"]), r["deleted_flg"])
                 for r in wh.history("terminals").collect())
    assert got == [
        ("T1", "Moscow", "2024-03-01", "2024-03-04", "N"), ("T1", "Omsk", "2024-03-05", "9999-12-31", "N"),
        ("T2", "Kazan", "2024-03-01", "2024-03-04", "N"), ("T2", "Kazan", "2024-03-05", "9999-12-31", "Y"),
    ]
    _write_csv(f"{drop}/passport_blacklist_01032024.txt", ["date", "passport"], [("2024-02-28", "OLD"), ("2024-03-01", "A")])
    _write_csv(f"{drop}/passport_blacklist_02032024.txt", ["date", "passport"],
               [("2024-02-28", "OLD"), ("2024-03-01", "A"), ("2024-03-02", "A"), ("2024-03-02", "B")])
    cp_b = os.path.join(workdir, "cp_b")
    FST.run_available(FST.blacklist_stream(spark, drop), P.blacklist_batch_writer(wh, "2024-03-02 23:00:00"), cp_b)
    bl = sorted((r["passport_num"], str(r["entry_dt"]), str(r["file_date"])) for r in wh.read("fact", "passport_blacklist").collect())
    assert bl == [("A", "2024-03-01", "2024-03-01"), ("B", "2024-03-02", "2024-03-02")]
    states = wh.read("meta", "date_points")
    assert states.filter(F.col("terminals_flg") == 1).count() == 2 and states.filter(F.col("passport_blacklist_flg") == 1).count() == 2


def test_jdbc_delete_then_restore_through_segments(spark, workdir):
    url, conn = _derby(spark, workdir)
    _exec(conn, CARDS_DDL, "INSERT INTO cards VALUES ('C1', 'A1', '2024-01-01 10:00:00', NULL)",
          "INSERT INTO cards VALUES ('C2', 'A2', '2024-01-01 10:00:00', NULL)")
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))

    def load(run_ts):
        changed = J.read_changes(spark, url, "CARDS", P.source_watermark(wh, "cards"), PROPS)
        changed = changed.toDF(*[c.lower() for c in changed.columns])
        P.merge_source_table(wh, "cards", changed, J.read_keys(spark, url, "CARDS", "CARD_NUM", PROPS), run_ts)

    load("2024-01-02 00:00:00")
    _exec(conn, "DELETE FROM cards WHERE card_num = 'C1'")
    load("2024-01-03 00:00:00")
    _exec(conn, "INSERT INTO cards VALUES ('C1', 'A9', '2024-01-01 10:00:00', '2024-01-04 08:00:00')")
    load("2024-01-05 00:00:00")
    got = sorted((r["card_num"], r["account_num"], r["effective_from"].strftime("%m-%d %H:%M"), r["effective_to"].strftime("%Y-%m-%d %H:%M:%S.%f")[:23], r["deleted_flg"])
                 for r in wh.history("cards").filter(F.col("card_num") == "C1").collect())
    assert got == [
        ("C1", "A1", "01-01 10:00", "2024-01-02 23:59:59.999", "N"),
        ("C1", "A1", "01-03 00:00", "2024-01-04 07:59:59.999", "Y"),
        ("C1", "A9", "01-04 08:00", "9999-12-31 00:00:00.000", "N"),
    ]
    # each run wrote the versions it closed into its own segment; the open
    # segment holds exactly one version per key
    segs = [x.rsplit("-", 1)[0] for x in wh.segments("cards") if x != "open"]
    assert segs == ["closed-20240103T000000", "closed-20240105T000000"]
    assert wh.open_versions("cards").groupBy("card_num").count().filter("count > 1").count() == 0
    conn.close()


def test_run_folder_processes_dates_in_order(spark, workdir):
    url, conn = _derby(spark, workdir)
    _exec(
        conn, CLIENTS_DDL, ACCOUNTS_DDL, CARDS_DDL,
        "INSERT INTO clients VALUES ('1', 'Ivanov', 'Ivan', 'I', '1980-01-01', 'P1', '2030-01-01', '+1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO accounts VALUES ('A1', '2030-01-01', '1', '2024-01-01 10:00:00', NULL)",
        "INSERT INTO cards VALUES ('C1', 'A1', '2024-01-01 10:00:00', NULL)",
    )
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    _load_dims(spark, wh, url, "2024-01-02 00:00:00")
    drop = os.path.join(workdir, "drop")
    os.makedirs(drop)
    # 31.03 must be processed before 01.04 although "01042024" < "31032024"
    _write_csv(f"{drop}/terminals_31032024.txt", TERM_HEADER, [("T1", "ATM", "Moscow", "a"), ("T2", "ATM", "Kazan", "b")])
    _write_csv(f"{drop}/terminals_01042024.txt", TERM_HEADER, [("T1", "ATM", "Moscow", "a"), ("T2", "ATM", "Perm", "b")])
    _write_csv(f"{drop}/transactions_31032024.txt", TX_HEADER, [("t1", "2024-03-31 23:50:00", "1", "C1", "PAYMENT", "SUCCESS", "T1")])
    _write_csv(f"{drop}/transactions_01042024.txt", TX_HEADER, [("t2", "2024-04-01 00:20:00", "1", "C1", "PAYMENT", "SUCCESS", "T2")])
    _write_csv(f"{drop}/readme.txt", ["x"], [("1",)])
    flags = P.run_folder(wh, drop, "2024-04-01 06:00:00")
    assert [f["terminals_flg"] for f in flags] == [1, 1]
    hist = sorted((r["terminal_id"], r["terminal_city"], str(r["effective_from"])) for r in wh.history("terminals").collect())
    assert ("T2", "Perm", "2024-04-01") in hist and ("T2", "Kazan", "2024-03-31") in hist
    rep = [(r["event_type"], r["event_dt"].strftime("%m-%d %H:%M")) for r in wh.report().collect()]
    assert rep == [(3, "04-01 00:20")]  # Moscow 23:50 -> Perm (terminal moved on 04-01) 00:20
    # processing the folder again changes nothing
    P.run_folder(wh, drop, "2024-04-01 07:00:00")
    assert wh.report().count() == 1 and wh.read("fact", "transactions").count() == 2
    conn.close()


def test_compact_closed_segments(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    days = ["2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04"]
    for i, day in enumerate(days):
        p = os.path.join(workdir, f"terminals_{i}.txt")
        _write_csv(p, TERM_HEADER, [("T1", "ATM", f"City{i}", "a"), ("T2", "POS", "Kazan", "b")])
        P.merge_terminals(wh, FS.read_snapshot(spark, p), day)
    before = sorted(tuple(r) for r in wh.history("terminals").collect())
    assert len([s for s in wh.segments("terminals") if s != "open"]) == 3
    assert P.compact_closed(wh, "terminals", "20240305") == "closed-compact-20240305"
    assert wh.segments("terminals") == ["closed-compact-20240305", "open"]
    assert sorted(tuple(r) for r in wh.history("terminals").collect()) == before
    # a repeated compaction (e.g. after a stop between write and delete) stays exact
    P.merge_terminals(wh, FS.read_snapshot(spark, os.path.join(workdir, "terminals_0.txt")), "2024-03-05")
    P.compact_closed(wh, "terminals", "20240306")
    h = wh.history("terminals")
    assert h.count() == h.dropDuplicates().count() == len(before) + 1


def test_drop_file_formats(spark, workdir):
    import pytest

    p = os.path.join(workdir, "terminals_01032024.parquet")
    spark.createDataFrame([("T1", "ATM", "Moscow", "a")], "terminal_id string, terminal_type string, terminal_city string, terminal_address string").write.parquet(p)
    assert P.read_drop_file(spark, p, "terminals").count() == 1
    with pytest.raises(ValueError, match="unsupported file format"):
        P.read_drop_file(spark, os.path.join(workdir, "terminals_01032024.xlsx"), "terminals")


def test_corrected_snapshot_of_a_day_keeps_closed_versions(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))

    def snap(*rows):
        return spark.createDataFrame([(t, "ATM", c, "a") for t, c in rows], "terminal_id string, terminal_type string, terminal_city string, terminal_address string")

    P.merge_terminals(wh, snap(("A", "c1"), ("B", "c1")), "2024-03-01")
    P.merge_terminals(wh, snap(("A", "c2"), ("B", "c1")), "2024-03-05")
    P.merge_terminals(wh, snap(("A", "c2"), ("B", "c9")), "2024-03-05")
    got = {(r["terminal_id"], r["terminal_city"], str(r["effective_from"])) for r in wh.history("terminals").collect()}
    assert {("A", "c1", "2024-03-01"), ("A", "c2", "2024-03-05"), ("B", "c9", "2024-03-05")} <= got
    P.merge_terminals(wh, snap(("A", "old")), "2024-03-02")
    late = {(r["terminal_id"], r["terminal_city"], str(r["effective_from"]), r["deleted_flg"]) for r in wh.history("terminals").collect()}
    assert late == {
        ("A", "c1", "2024-03-01", "N"), ("A", "old", "2024-03-02", "N"), ("A", "c2", "2024-03-05", "N"),
        ("B", "c1", "2024-03-01", "N"), ("B", "c1", "2024-03-02", "Y"), ("B", "c9", "2024-03-05", "N"),
    }
    # a run that stops before it publishes leaves readers on the old version
    before = sorted(map(tuple, wh.history("terminals").collect()))
    publish = P.Warehouse.publish
    try:
        P.Warehouse.publish = lambda *a: (_ for _ in ()).throw(RuntimeError("stopped"))
        with pytest.raises(RuntimeError):
            P.merge_terminals(wh, snap(("A", "c3")), "2024-03-06")
    finally:
        P.Warehouse.publish = publish
    assert sorted(map(tuple, wh.history("terminals").collect())) == before
    P.merge_terminals(wh, snap(("A", "c3")), "2024-03-06")
    assert ("A", "c3") in {(r["terminal_id"], r["terminal_city"]) for r in wh.history("terminals").collect()}


def test_report_rerun_without_hits_leaves_no_rows(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    row = spark.sql("select date'2024-03-01' report_dt, 2 event_type, timestamp_ntz'2024-03-01 10:00:00' event_dt, 'p' passport")
    other = spark.sql("select date'2024-03-01' report_dt, 4 event_type, timestamp_ntz'2024-03-01 11:00:00' event_dt, 'q' passport")
    wh.write_report(row.union(other), ("2024-03-01", "2024-03-01"), [2, 4])
    wh.write_report(row.limit(0), ("2024-03-01", "2024-03-01"), [2])
    assert [r["passport"] for r in wh.report().collect()] == ["q"]


def test_run_folder_loads_every_file_of_a_day(spark, workdir):
    wh = P.Warehouse(spark, os.path.join(workdir, "wh"))
    drop, archive = os.path.join(workdir, "drop"), os.path.join(workdir, "archive")
    os.makedirs(drop)
    _write_csv(f"{drop}/transactions_01032024.txt", TX_HEADER, [("t1", "2024-03-01 10:00:00", "1", "C1", "PAYMENT", "SUCCESS", "T1")])
    _write_csv(f"{drop}/transactions_01032024_part2.txt", TX_HEADER, [("t2", "2024-03-01 11:00:00", "1", "C1", "PAYMENT", "SUCCESS", "T1")])
    _write_csv(f"{drop}/transactions_29022024.xlsx", TX_HEADER, [("t0", "2024-02-29 11:00:00", "1", "C1", "PAYMENT", "SUCCESS", "T1")])
    first = P.run_folder(wh, drop, "2024-03-02 00:00:00", archive=archive)
    assert any("error" in r for r in first)  # the unreadable file is reported, the other day still ran
    assert {r["trans_id"] for r in wh.read("fact", "transactions").collect()} == {"t1", "t2"}
    assert any("transactions_01032024.txt.backup" in n for n in os.listdir(archive))
    _write_csv(f"{drop}/transactions_01032024_late.txt", TX_HEADER, [("t3", "2024-03-01 12:00:00", "1", "C1", "PAYMENT", "SUCCESS", "T1")])
    P.run_folder(wh, drop, "2024-03-03 00:00:00", archive=archive)
    assert {r["trans_id"] for r in wh.read("fact", "transactions").collect()} == {"t1", "t2", "t3"}
