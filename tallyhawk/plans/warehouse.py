"""Warehouse layout, idempotent writers and the daily run.

Layout under one base folder (a shared file system on a cluster)::

    hist/<dimension>/open-<run>/                    open versions (written anew per run)
    hist/<dimension>/closed-<run>/                  versions closed by that run
    hist/<dimension>/manifest/<version>.json        the parts that make up the history
    fact/transactions/trans_day=D/load_id=<file>/   by operation day, then loaded file
    fact/passport_blacklist/file_date=D/load_id=<file>/
    report/fraud/report_dt=D/event_type=N/          recomputed per (day, rule)
    meta/load_watermark/                            one row per source table, published by a manifest
    meta/date_points/                               appended load-state rows

Every write is a dynamic partition overwrite of partitions owned by the
current unit of work, so a rerun after a failure (a replayed stream batch,
a restarted daily job) rewrites exactly what it wrote before:

* facts: the partitions of the file being loaded (the anti join against the
  fact skips that file's own partitions, so a replay sees the same input);
  transactions are partitioned by operation day first, so a daily rule run
  and the load's anti join prune to a few days of the fact;
* history: the open segment and the segment closed by this run; merges read
  only ``segment=open`` (partition pruning), closed history is never read by
  a merge (``compact_closed`` folds accumulated closed segments into one
  between runs);
* report: the (report_dt, event_type) partitions recomputed from the facts.

Lineage is cut with a reliable ``checkpoint()`` into ``spark.checkpoint.dir``
(a shared folder on a cluster) before a table that was read is overwritten.
"""

from __future__ import annotations

import uuid
import json
import datetime as dt
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C
from tallyhawk.operators import affected as AF
from tallyhawk.operators import facts as L
from tallyhawk.operators import rules as R
from tallyhawk.operators import scd2 as S
from tallyhawk.operators import state as ST
from tallyhawk.session import checkpoint_dir

OPEN_SEGMENT = "open"
LOAD_ID = "load_id"
TRANS_DAY = "trans_day"
TERMINAL_TRACKED = ["terminal_type", "terminal_city", "terminal_address"]


# ------------------------------------------------------------------ staging


def stage_clients(src: DataFrame) -> DataFrame:
    """Client rows as merged: a passport without an end date is valid until
    technical infinity (applied before the change comparison, so a re-read
    row is not seen as changed); fixed-width phone numbers are trimmed."""
    return src.withColumn("passport_valid_to", F.coalesce(F.col("passport_valid_to"), X.inf_date())).withColumn(
        "phone", F.rtrim(F.col("phone"))
    )


def rtrim_strings(df: DataFrame) -> DataFrame:
    """Right-trim every string column (blank-padded CHAR(n) source fields)."""
    return df.select(*[F.rtrim(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def stage_source(df: DataFrame, table: str) -> DataFrame:
    """Source columns renamed to warehouse names, CHAR padding removed;
    clients also get the passport sentinel."""
    from tallyhawk.sources.jdbc import source_columns

    out = rtrim_strings(source_columns(df, table))
    return stage_clients(out) if table == "clients" else out


TRACKED = {t: [w for _, w in cols[1:]] for t, cols in C.SOURCE_COLUMNS.items()}
KEYS = {t: cols[0][1] for t, cols in C.SOURCE_COLUMNS.items()}
#: Key, tracked columns and grain of every history.
DIMENSIONS = {t: ([KEYS[t]], TRACKED[t], "ms") for t in KEYS} | {"terminals": (["terminal_id"], TERMINAL_TRACKED, "day")}


# ------------------------------------------------------------------ tables

#: Columns of the tables that can be without rows.
TABLES = {
    "fact/transactions": (
        "trans_id string, trans_date timestamp_ntz, amt decimal(18,2), card_num string, oper_type string, oper_result string,"
        f" terminal string, {C.FILE_DATE_COL} date, {TRANS_DAY} date, {LOAD_ID} string"
    ),
    "fact/passport_blacklist": (
        f"entry_dt date, passport_num string, {C.PROCESSED_COL} timestamp_ntz, {C.FILE_DATE_COL} date, {LOAD_ID} string"
    ),
    "report/fraud": "event_dt timestamp_ntz, passport string, fio string, phone string, report_dt date, event_type int",
    "meta/date_points": "date_point date, " + ", ".join(f"{f} int" for f in ST.ALL_FLAGS),
    "meta/files": "name string, day string",
}
WATERMARK = "schema_name string, table_name string, max_update_dt timestamp_ntz"


@dataclass
class Warehouse:
    spark: SparkSession
    base: str
    _cp: str | None = field(default=None, init=False)

    def path(self, *parts: str) -> str:
        return os.path.join(self.base, *parts)

    def exists(self, *parts: str) -> bool:
        sc = self.spark.sparkContext
        hp = sc._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return hp.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hp)

    def read(self, *parts: str) -> DataFrame | None:
        """A table, None before its first write.  A table whose writes had no
        rows so far (a first file without rows, a report without hits) is a
        folder without data files: empty, with its declared columns."""
        if not self.exists(*parts):
            return None
        Path, conf = self._fs()
        root = Path(self.path(*parts))
        files = root.getFileSystem(conf).listFiles(root, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                return self.spark.read.parquet(self.path(*parts))
        return self.spark.createDataFrame([], TABLES["/".join(parts)])

    def cut(self, df: DataFrame) -> DataFrame:
        """Materialise ``df`` reliably (survives executor loss) and drop lineage."""
        if self._cp is None:
            self._cp = checkpoint_dir(self.spark)
            if self._cp is None:
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return df.checkpoint(eager=True)

    def _overwrite(self, df: DataFrame, parts: list[str], *path: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*parts).parquet(self.path(*path)))

    def _escape(self, name: str) -> str:
        return self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)

    def _replace(self, rows: DataFrame, parts: list[str], covered: str, *path: str) -> None:
        """Replace exactly the partition folders that match ``covered`` (a
        glob below the table): those that get no rows any more are removed,
        then the others overwritten, so a run that stops in between leaves no
        row that is no longer true."""
        Path, conf = self._fs()
        glob = Path(self.path(*path, covered))
        fs = glob.getFileSystem(conf)
        before = [st.getPath() for st in (fs.globStatus(glob) or [])]
        rows = self.cut(rows)
        # one entry per partition folder written, as many as the run covers
        written = rows.select(*parts).distinct().collect()
        kept = {"/".join(f"{c}={self._escape(str(v))}" for c, v in zip(parts, r)) for r in written}
        for p in before:
            if "/".join(p.toString().split("/")[-len(parts):]) not in kept:
                fs.delete(p, True)
        self._overwrite(rows, parts, *path)

    # -- history: parts are written under new names and become visible when a
    # manifest naming them is renamed into place; nothing that a reader or an
    # interrupted run could need is overwritten
    def manifest(self, dim: str, kind: str = "hist") -> dict:
        Path, conf = self._fs()
        root = Path(self.path(kind, dim, "manifest"))
        fs = root.getFileSystem(conf)
        names = [st.getPath().getName() for st in fs.listStatus(root)] if fs.exists(root) else []
        names = sorted(n for n in names if n.endswith(".json"))
        if not names:
            return {"version": 0, "open": None, "closed": [], "as_of": None, "before": None}
        stream = fs.open(Path(root, names[-1]))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, dim: str, manifest: dict, kind: str = "hist") -> None:
        """Make a manifest the newest one.  The rename must be atomic and fail
        where the name exists, as on HDFS; an object store needs a committer
        that gives the same."""
        Path, conf = self._fs()
        root = Path(self.path(kind, dim, "manifest"))
        fs = root.getFileSystem(conf)
        part = Path(root, f"{uuid.uuid4().hex}.part")
        stream = fs.create(part)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        final = Path(root, f"{manifest['version']:010d}.json")
        if fs.exists(final) or not fs.rename(part, final):
            raise RuntimeError(f"another run published version {manifest['version']} of {dim}")

    def _parts(self, dim: str, names: list[str]) -> DataFrame | None:
        return self.spark.read.parquet(*[self.path("hist", dim, n) for n in names]) if names else None

    def open_versions(self, dim: str) -> DataFrame | None:
        m = self.manifest(dim)
        return self._parts(dim, [m["open"]] if m["open"] else [])

    def history(self, dim: str) -> DataFrame | None:
        m = self.manifest(dim)
        return self._parts(dim, ([m["open"]] if m["open"] else []) + m["closed"])

    def at(self, dim: str, manifest: dict) -> DataFrame | None:
        """The history that a manifest names."""
        return self._parts(dim, ([manifest["open"]] if manifest["open"] else []) + manifest["closed"])

    def diff(self, dim: str, old: dict, new: dict) -> DataFrame | None:
        """Where two published states of a history differ, None if they are
        the same; closed parts that both name are not read."""
        names = [set(([m["open"]] if m["open"] else []) + m["closed"]) for m in (old, new)]
        if not old["version"] or names[0] == names[1]:
            return None
        a, b = (self._parts(dim, sorted(x - y)) for x, y in (names, names[::-1]))
        if a is None or b is None:
            a, b = (x if x is not None else y.limit(0) for x, y in ((a, b), (b, a)))
        keys, tracked, grain = DIMENSIONS[dim]
        return AF.history_diff(a, b, keys, tracked, grain)

    def watermarks(self) -> DataFrame | None:
        part = self.manifest("load_watermark", "meta")["open"]
        return self.spark.read.schema(WATERMARK).parquet(self.path("meta", "load_watermark", part)) if part else None

    def write_watermarks(self, rows: DataFrame) -> None:
        """The new watermarks beside the old ones, then published: a run that
        stops before leaves the old ones."""
        m = self.manifest("load_watermark", "meta")
        part = f"part-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(self.path("meta", "load_watermark", part))
        self.publish("load_watermark", {**m, "version": m["version"] + 1, "open": part, "before": m["open"]}, "meta")
        if m["before"]:
            Path, conf = self._fs()
            old = Path(self.path("meta", "load_watermark", m["before"]))
            old.getFileSystem(conf).delete(old, True)

    def write_history(self, dim: str, merged: DataFrame, run_id: str, grain: str, as_of: str | None = None, whole: bool = False) -> None:
        """Publish the new open versions and, beside the closed parts so far
        (instead of them if ``merged`` is the whole history), the newly closed."""
        m = self.manifest(dim)
        rows = self.cut(merged)
        tag = f"{run_id}-{uuid.uuid4().hex[:8]}"
        is_open = F.coalesce(X.is_open(C.TO_COL, grain), F.lit(False))
        rows.filter(is_open).write.parquet(self.path("hist", dim, f"open-{tag}"))
        closed = rows.filter(~is_open)
        new = [] if closed.isEmpty() else [f"closed-{tag}"]
        if new:
            closed.write.parquet(self.path("hist", dim, new[0]))
        self.publish(dim, {
            "version": m["version"] + 1, "open": f"open-{tag}", "closed": ([] if whole else m["closed"]) + new,
            "as_of": max(filter(None, (m["as_of"], as_of)), default=None), "before": m["open"],
            "days": sorted({*m.get("days", filter(None, [m["as_of"]])), *filter(None, [as_of])}),
        })
        if m["before"]:  # the open part before the last one: no reader starts on it any more
            self.drop_segments(dim, [m["before"]])

    # -- facts, report, state
    def write_fact(self, name: str, rows: DataFrame, load_ids: list[str]) -> None:
        """Replace the rows of the given loads."""
        day = C.FILE_DATE_COL
        if name == "transactions":
            day, rows = TRANS_DAY, rows.withColumn(TRANS_DAY, F.to_date("trans_date"))
        loads = ",".join(self._escape(i) for i in load_ids)
        self._replace(rows, [day, LOAD_ID], f"{day}=*/{LOAD_ID}={{{loads}}}", "fact", name)

    def write_report(self, report: DataFrame, days, rules) -> None:
        """Replace the report of the evaluated days (all if None) and rules."""
        # range partitioning: each task writes few (day, type) folders, and a
        # day holding a huge share of the hits is split over several tasks
        ranged = report.repartitionByRange("report_dt", "event_type", "event_dt")
        on = "*"
        if days is not None:
            first, last = (dt.date.fromisoformat(str(d)) for d in days)
            on = "{" + ",".join(str(first + dt.timedelta(n)) for n in range((last - first).days + 1)) + "}"
        types = "{" + ",".join(str(r) for r in rules) + "}"
        self._replace(ranged, ["report_dt", "event_type"], f"report_dt={on}/event_type={types}", "report", "fraud")

    def append_state(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path("meta", name))

    def report(self) -> DataFrame | None:
        return self.read("report", "fraud")

    def _fs(self):
        sc = self.spark.sparkContext
        return sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()

    def segments(self, dim: str) -> list[str]:
        """Published parts of a history: its closed ones and 'open'."""
        m = self.manifest(dim)
        return sorted(m["closed"] + ([OPEN_SEGMENT] if m["open"] else []))

    def archive(self, folder: str, archive: str, names: list[str]) -> None:
        Path, conf = self._fs()
        target = Path(archive)
        fs = target.getFileSystem(conf)
        fs.mkdirs(target)
        for name in names:
            fs.rename(Path(folder, name), Path(target, name + ".backup"))

    def drop_segments(self, dim: str, segments: list[str]) -> None:
        Path, conf = self._fs()
        for seg in segments:
            p = Path(self.path("hist", dim, seg))
            p.getFileSystem(conf).delete(p, True)


def _run_id(run_ts: str) -> str:
    return run_ts.replace("-", "").replace(":", "").replace(" ", "T")


# ------------------------------------------------------------------ dimension loads


def merge_source_table(wh: Warehouse, table: str, changed: DataFrame, live_keys: DataFrame, run_ts: str) -> None:
    """M-1 for one source table into its history, then its watermark (M-4).

    ``changed``/``live_keys`` are source-named frames (e.g. from
    :func:`tallyhawk.sources.jdbc.read_changes` / ``read_keys``).
    """
    key, tracked = KEYS[table], TRACKED[table]
    staged = stage_source(changed, table)
    open_rows = wh.open_versions(table)
    if open_rows is None:
        keys = live_keys.select(F.rtrim(F.col(live_keys.columns[0])).alias(key))
        merged = S.scd2_initial(staged, key, tracked, run_ts, live_keys=keys)
    else:
        keys = live_keys.select(F.rtrim(F.col(live_keys.columns[0])).alias(key))
        merged = S.scd2_merge_incremental(open_rows, staged, keys, key, tracked, run_ts)
    wh.write_history(table, merged, _run_id(run_ts), grain="ms")
    meta = wh.watermarks()
    if meta is None:
        meta = wh.spark.createDataFrame([], WATERMARK)
    wh.write_watermarks(ST.advance_watermark(meta, {table: changed}))


def compact_closed(wh: Warehouse, dim: str, stamp: str) -> str | None:
    """Rewrite every closed segment of a history as one segment.

    Closed versions never change, so copies are exact and a plain
    ``dropDuplicates`` makes the step safe to repeat: if it stops after the
    write, the next compaction reads the old and new segments and writes one
    clean segment again.  Run it between warehouse runs (readers of the
    history would briefly see both copies).  Returns the new segment name.
    """
    m = wh.manifest(dim)
    old = m["closed"]
    if len(old) < 2:
        return None
    name = f"closed-compact-{stamp}"
    wh._parts(dim, old).dropDuplicates().write.mode("overwrite").parquet(wh.path("hist", dim, name))
    wh.publish(dim, {**m, "version": m["version"] + 1, "closed": [name]})
    wh.drop_segments(dim, [s for s in old if s != name])
    return name


def source_watermark(wh: Warehouse, table: str):
    meta = wh.watermarks()
    return None if meta is None else ST.watermark_lookup(meta, table)


def merge_terminals(wh: Warehouse, snapshot: DataFrame, day: str) -> None:
    """M-2: a full terminal snapshot of ``day`` into the DATE-grain history.

    Snapshots may arrive in any order: one of a day before the newest merged
    one (or another one of the same day) is put into the history at its own
    day, which gives the history of the chronological order."""
    m = wh.manifest("terminals")
    rows = snapshot.select("terminal_id", *TERMINAL_TRACKED)
    run_id = day.replace("-", "")
    if m["as_of"] and day <= m["as_of"]:
        after = [d for d in m.get("days", [m["as_of"]]) if d > day]  # one entry per merged snapshot
        merged = S.scd2_insert_snapshot(wh.at("terminals", m), rows, "terminal_id", TERMINAL_TRACKED, day, min(after, default=None))
        return wh.write_history("terminals", merged, run_id, grain="day", as_of=day, whole=True)
    open_rows = wh.open_versions("terminals")
    if open_rows is None:
        open_rows = S.empty_history(wh.spark, {"terminal_id": "string"}, {c: "string" for c in TERMINAL_TRACKED},
                                    "day", {C.FILE_DATE_COL: "date"})
    merged = S.scd2_merge_snapshot(open_rows, rows, "terminal_id", TERMINAL_TRACKED, day, grain="day",
                                   extras={C.FILE_DATE_COL: X.date_lit(day)})
    return wh.write_history("terminals", merged, run_id, grain="day", as_of=day)


# ------------------------------------------------------------------ fact loads


def _tx_fact(wh: Warehouse) -> DataFrame:
    f = wh.read("fact", "transactions")
    if f is None:
        return wh.spark.createDataFrame([], "trans_id string, trans_date timestamp_ntz, trans_day date, load_id string")
    return f


def load_transactions_rows(wh: Warehouse, delta: DataFrame, load_ids: list[str]) -> DataFrame:
    """New fact rows of ``delta`` (which carries file_date and load_id); the
    fact is pruned to the operation days the delta covers (partition pruning
    on ``trans_day``)."""
    existing = _tx_fact(wh).filter(~F.col(LOAD_ID).isin(load_ids))
    return L.load_transactions(existing, delta, None, existing_day_col=TRANS_DAY, carry=[C.FILE_DATE_COL, LOAD_ID])


def load_transactions_file(wh: Warehouse, delta: DataFrame, day: str, load_id: str | None = None) -> None:
    """L-1 + K-1: append the new rows of one daily transaction file."""
    load_id = load_id or f"transactions_{day}"
    d = delta.withColumn(C.FILE_DATE_COL, X.date_lit(day)).withColumn(LOAD_ID, F.lit(load_id))
    wh.write_fact("transactions", load_transactions_rows(wh, d, [load_id]), [load_id])


def load_blacklist_file(wh: Warehouse, mtd: DataFrame, day: str, run_ts: str, load_id: str | None = None) -> None:
    """L-2 + K-2: append passports first listed on ``day``."""
    load_id = load_id or f"passport_blacklist_{day}"
    existing = wh.read("fact", "passport_blacklist")
    if existing is None:
        existing = wh.spark.createDataFrame([], "passport_num string, load_id string")
    existing = existing.filter(F.col(LOAD_ID) != load_id)
    rows = L.load_blacklist(existing, mtd, day, run_ts).withColumn(LOAD_ID, F.lit(load_id))
    wh.write_fact("passport_blacklist", rows, [load_id])


# ------------------------------------------------------------------ rules


DIM_TYPES = {
    "cards": ({"card_num": "string"}, {"account_num": "string"}),
    "accounts": ({"account_num": "string"}, {"valid_to": "date", "client": "string"}),
    "clients": (
        {"client_id": "string"},
        {"last_name": "string", "first_name": "string", "patronymic": "string", "date_of_birth": "date",
         "passport_num": "string", "passport_valid_to": "date", "phone": "string"},
    ),
}


def dimensions(wh: Warehouse) -> R.Dimensions:
    """Current histories of cards/accounts/clients (empty before their first load)."""
    def get(dim):
        h = wh.history(dim)
        return h if h is not None else S.empty_history(wh.spark, *DIM_TYPES[dim], grain="ms")

    return R.Dimensions(cards=get("cards"), accounts=get("accounts"), clients=get("clients"))


def report_frame(wh: Warehouse, days, rules) -> tuple[DataFrame | None, list[int]]:
    """The report rows of ``rules`` for report days ``(first, last)`` (all
    days when None) and the rules that could run."""
    tx = wh.read("fact", "transactions")
    if tx is None or not rules:
        return None, []
    if days is not None:
        # partition pruning: the rules look back at most one window before
        # the first day (the exact time bound is applied by the rules)
        reach = -(-max(C.CITY_HOP_WINDOW_SECONDS, C.AMOUNT_PROBE_WINDOW_SECONDS) // 86400)
        first, last = (F.lit(str(d)).cast("date") for d in days)
        tx = tx.filter(F.col(TRANS_DAY).between(F.date_sub(first, reach), last))
    bl = wh.read("fact", "passport_blacklist")
    if bl is None:
        bl = wh.spark.createDataFrame([], "entry_dt date, passport_num string")
    terminals = wh.history("terminals")
    rules = tuple(r for r in rules if r != 3 or terminals is not None)
    if not rules:
        return None, []
    return R.fraud_report(tx, dimensions(wh), terminals, bl, report_days=days, rules=rules), list(rules)


def run_rules(wh: Warehouse, days, rules) -> list[int]:
    """Evaluate ``rules`` for report days ``(first, last)`` and overwrite their
    report partitions.  Returns the rules actually run."""
    report, done = report_frame(wh, days, rules)
    if report is not None:
        wh.write_report(report, days, done)
    return done


def day_state(wh: Warehouse, day: str) -> dict:
    points = wh.read("meta", "date_points")
    flags = {f: 0 for f in ST.ALL_FLAGS}
    if points is not None:
        row = ST.latest_state(points.filter(F.col("date_point") == X.date_lit(day))).first()
        if row is not None:
            flags.update({f: int(row[f]) for f in ST.ALL_FLAGS})
    return flags


def rules_ready(flags: dict) -> list[int]:
    """O-3 for one date's flags."""
    todo = []
    if flags["transactions_flg"]:
        if flags["passport_blacklist_flg"] and not flags["event_type_1_rep"]:
            todo.append(1)
        if not flags["event_type_2_rep"]:
            todo.append(2)
        if flags["terminals_flg"] and not flags["event_type_3_rep"]:
            todo.append(3)
        if not flags["event_type_4_rep"]:
            todo.append(4)
    return todo


def load_dimensions(wh: Warehouse, sources: dict, run_ts: str) -> dict[str, str]:
    """First step of a run: merge every source table into its history.

    ``sources`` maps clients / accounts / cards to (changed rows, live keys)
    or to a function of the stored watermark that returns them.  A table that
    fails doesn't stop the others; returns the errors by table.
    """
    errors = {}
    for name, source in sources.items():
        try:
            changed, live = source(source_watermark(wh, name)) if callable(source) else source
            old = wh.manifest(name)
            merge_source_table(wh, name, changed, live, run_ts)
            rerun(wh, affected_by_history(wh, name, old))
        except Exception as exc:  # the step failed: reported, the next run retries it
            errors[name] = repr(exc)[:500]
    return errors


def run_date(wh: Warehouse, day: str, run_ts: str, files: dict) -> dict:
    """O-4: load what arrived for ``day`` and run the rules that became possible.

    ``files`` maps 'terminals' / 'transactions' / 'passport_blacklist' to the
    DataFrame of that day's file, loaded at most once per day (load-state
    flags), or to a list of (file name, DataFrame): each is loaded under its
    name, and rules already run for the day are run again on the fuller data,
    as are those of other days that a load touches (the window after its
    operations, operations of newly listed passports, changed terminals).
    A step that fails raises, its flag stays 0 and the next run retries it.
    Returns the new flags (also appended to the state).
    """
    flags = day_state(wh, day)
    again, touched = False, set()
    for kind in ("terminals", "transactions", "passport_blacklist"):
        given = files.get(kind, [])
        for name, rows in given if isinstance(given, list) else [(None, given)]:
            if name is None and flags[f"{kind}_flg"]:
                continue
            fact, load_id = kind, name or f"{kind}_{day}"
            if kind == "terminals":
                old = wh.manifest("terminals")
                merge_terminals(wh, rows, day)
                touched |= affected_by_history(wh, "terminals", old)
            else:
                touched |= affected_by_load(wh, fact, [load_id])  # rows this load had before
                if kind == "transactions":
                    load_transactions_file(wh, rows, day, name)
                else:
                    load_blacklist_file(wh, rows, day, run_ts, name)
                touched |= affected_by_load(wh, fact, [load_id])
            flags[f"{kind}_flg"] = 1
            again = again or name is not None
    open_rules = {**flags, **{f: 0 for f in ST.RULE_FLAGS}} if again else flags
    done = run_rules(wh, (day, day), rules_ready(open_rules))
    rerun(wh, touched - {(dt.date.fromisoformat(day), r) for r in done})
    for r in done:
        flags[f"event_type_{r}_rep"] = 1
    row = wh.spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("date_point"))
    wh.append_state("date_points", ST.date_point_rows(row, flags))
    return flags


def run_ready(wh: Warehouse, days: list, rules) -> None:
    """Run those of ``rules`` whose inputs have arrived, for each of a few days
    (again where they had run: an input has changed)."""
    for day in map(str, days):
        flags = {**day_state(wh, day), **{f"event_type_{r}_rep": 0 for r in rules}}
        done = run_rules(wh, (day, day), [r for r in rules_ready(flags) if r in rules])
        if done:
            row = wh.spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("date_point"))
            wh.append_state("date_points", ST.date_point_rows(row, {f"event_type_{r}_rep": 1 for r in done}))


# ------------------------------------------------------------------ affected days


def _pairs(frame: DataFrame | None) -> set[tuple]:
    """(day, rule) pairs: at most the report's days times its rules."""
    return set() if frame is None else {(r["report_dt"], r["event_type"]) for r in frame.select(*AF.PAIR).distinct().collect()}


def _load_rows(wh: Warehouse, name: str, load_ids: list[str]) -> DataFrame | None:
    rows = wh.read("fact", name)
    return None if rows is None else rows.filter(F.col(LOAD_ID).isin(load_ids))


def affected_by_load(wh: Warehouse, name: str, load_ids: list[str]) -> set[tuple]:
    """Report days and rules that the stored rows of the loads touch."""
    rows = _load_rows(wh, name, load_ids)
    if rows is None:
        return set()
    if name == "transactions":
        return _pairs(AF.days_of_operations(rows))
    tx, dims = wh.read("fact", "transactions"), dimensions(wh)
    return set() if tx is None else _pairs(AF.days_of_listings(tx, rows, dims.cards, dims.accounts, dims.clients))


def affected_by_history(wh: Warehouse, dim: str, old: dict) -> set[tuple]:
    """Report days and rules touched by what changed in a history since the
    manifest ``old`` (its parts must still be there)."""
    tx, diff = wh.read("fact", "transactions"), wh.diff(dim, old, wh.manifest(dim))
    if tx is None or diff is None:
        return set()
    if dim == "terminals":
        return _pairs(AF.days_of_terminals(tx, diff))
    dims = dimensions(wh)
    return _pairs(AF.days_of_cards(tx, AF.changed_cards(diff, dim, dims.cards, dims.accounts)))


def rerun(wh: Warehouse, pairs: set[tuple]) -> None:
    """Evaluate again exactly the (day, rule) pairs that had been evaluated, or
    whose day has no load state of its own (operations of a day without a
    file); the others run once their inputs have arrived.  Neighbouring days
    with the same rules are one job."""
    plan = []
    for day in sorted({d for d, _ in pairs}):
        flags = day_state(wh, str(day))
        due = tuple(r for r in AF.ALL_RULES if (day, r) in pairs and (flags[f"event_type_{r}_rep"] or not any(flags.values())))
        if due and plan and plan[-1][2] == due and plan[-1][1] + dt.timedelta(1) == day:
            plan[-1][1] = day
        elif due:
            plan.append([day, day, due])
    for first, last, rules in plan:
        run_rules(wh, (first, last), rules)


# ------------------------------------------------------------------ streamed files


def transactions_batch_writer(wh: Warehouse, rules=(2, 4)):
    """``foreachBatch`` function for :func:`tallyhawk.streaming.file_stream.transactions_stream`.

    Loads every file of the micro-batch (each into its own fact partition),
    then recomputes ``rules`` for the batch's file days and appends their
    load state.  Replaying a batch rewrites the same partitions.
    """
    from tallyhawk.streaming.file_stream import FILE_NAME

    def process(batch: DataFrame, epoch_id: int) -> None:
        # several actions read the batch: keep it for the duration of the
        # function (lost blocks are recomputed from the batch's files)
        delta = batch.withColumnRenamed(FILE_NAME, LOAD_ID).persist()
        try:
            # the files of one micro-batch: bounded by maxFilesPerTrigger
            load_ids = [r[0] for r in delta.select(LOAD_ID).distinct().collect()]
            if not load_ids:
                return
            touched = affected_by_load(wh, "transactions", load_ids)
            wh.write_fact("transactions", load_transactions_rows(wh, delta, load_ids), load_ids)
            touched |= affected_by_load(wh, "transactions", load_ids)
            lo_hi = delta.agg(F.min(C.FILE_DATE_COL).alias("lo"), F.max(C.FILE_DATE_COL).alias("hi")).first()
            done = run_rules(wh, (lo_hi["lo"], lo_hi["hi"]), rules)
            flags = {"transactions_flg": 1, **{f"event_type_{r}_rep": 1 for r in done}}
            days = delta.select(F.col(C.FILE_DATE_COL).alias("date_point")).distinct()
            wh.append_state("date_points", ST.date_point_rows(days, flags))
            # a batch has at most maxFilesPerTrigger file days
            own = [r[0] for r in days.collect()]
            run_ready(wh, own, [r for r in (1, 3) if r not in rules])
            rerun(wh, touched - {(d, r) for d in own for r in AF.ALL_RULES})
        finally:
            delta.unpersist()

    return process


def terminals_batch_writer(wh: Warehouse):
    """``foreachBatch`` for :func:`tallyhawk.streaming.file_stream.terminals_stream`:
    merges the batch's snapshot (one file per batch) as of its file date and
    records the load state; rule 3 becomes runnable for that date."""
    from tallyhawk.streaming.file_stream import FILE_NAME

    def process(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            _merge_snapshot_batch(batch)
        finally:
            batch.unpersist()

    def _merge_snapshot_batch(batch: DataFrame) -> None:
        # one file per batch (maxFilesPerTrigger=1): its date is one scalar
        row = batch.agg(F.min(C.FILE_DATE_COL).alias("d"), F.countDistinct(FILE_NAME).alias("n")).first()
        if row is None or row["d"] is None:
            return
        if row["n"] != 1:
            raise ValueError("terminal snapshots must arrive one file per batch")
        day = str(row["d"])
        old = wh.manifest("terminals")
        merge_terminals(wh, batch.select("terminal_id", *TERMINAL_TRACKED), day)
        touched = affected_by_history(wh, "terminals", old)
        days = batch.select(F.col(C.FILE_DATE_COL).alias("date_point")).distinct()
        wh.append_state("date_points", ST.date_point_rows(days, {"terminals_flg": 1}))
        run_ready(wh, [day], [3])
        rerun(wh, touched - {(row["d"], 3)})

    return process


def blacklist_batch_writer(wh: Warehouse, run_ts: str):
    """``foreachBatch`` for :func:`tallyhawk.streaming.file_stream.blacklist_stream`.

    Every month-to-date file contributes the rows of its own date (a column
    comparison, so any number of files per batch); passports already in the
    fact, or in an earlier file of the batch, are skipped.
    """
    from tallyhawk.streaming.file_stream import FILE_NAME

    def process(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            _load_blacklist_batch(batch)
        finally:
            batch.unpersist()

    def _load_blacklist_batch(batch: DataFrame) -> None:
        rows = batch.filter(F.col("date") == F.col(C.FILE_DATE_COL))
        first = rows.groupBy("passport_num").agg(
            F.min(F.struct(F.col("date").alias("entry_dt"), F.col(C.FILE_DATE_COL).alias("fd"), F.col(FILE_NAME).alias("lid"))).alias("_m")
        )
        load_ids = [r[0] for r in batch.select(FILE_NAME).distinct().collect()]
        if not load_ids:
            return
        existing = wh.read("fact", "passport_blacklist")
        if existing is None:
            existing = wh.spark.createDataFrame([], "passport_num string, load_id string")
        existing = existing.filter(~F.col(LOAD_ID).isin(load_ids))
        new = first.join(existing.select("passport_num"), "passport_num", "left_anti").select(
            F.col("_m.entry_dt").alias("entry_dt"), "passport_num", X.ts_lit(run_ts).alias(C.PROCESSED_COL),
            F.col("_m.fd").alias(C.FILE_DATE_COL), F.col("_m.lid").alias(LOAD_ID),
        )
        wh.write_fact("passport_blacklist", new, load_ids)
        days = batch.select(F.col(C.FILE_DATE_COL).alias("date_point")).distinct()
        wh.append_state("date_points", ST.date_point_rows(days, {"passport_blacklist_flg": 1}))
        own = [r[0] for r in days.collect()]
        run_ready(wh, own, [1])
        rerun(wh, affected_by_load(wh, "passport_blacklist", load_ids) - {(d, 1) for d in own})

    return process


def read_drop_file(spark, path: str, kind: str) -> DataFrame:
    """Read one dropped file (';'-separated text with a header, or Parquet
    with the same columns) as the DataFrame ``run_date`` expects."""
    from tallyhawk.sources import files as FS

    ext = os.path.splitext(path)[1].lower()
    if ext not in (".txt", ".csv", ".parquet"):
        raise ValueError(f"unsupported file format {ext!r} for {path}: provide CSV or Parquet")
    fmt = "parquet" if ext == ".parquet" else "csv"
    if kind == "transactions":
        if fmt == "parquet":
            return FS.normalize_transactions(spark.read.parquet(path))
        return FS.read_transactions_csv(spark, path)
    if kind == "terminals":
        return FS.read_snapshot(spark, path, fmt)
    return FS.read_accumulating(spark, path, fmt).withColumnRenamed("passport", "passport_num")


def run_folder(wh: Warehouse, folder: str, run_ts: str, sources: dict | None = None, archive: str | None = None) -> list[dict]:
    """O-4 over a drop folder: load the dimensions, find the dated files not
    loaded yet, and run every date in chronological order (not by the DDMMYYYY
    text).  Every file of a kind and day is loaded, also one that arrives
    later; files, not days, are registered as loaded (``meta/files``).  A file
    or day that fails is reported in its result under 'error' and doesn't stop
    the others; the next run retries it.  With ``archive``, loaded files are
    moved there under their name with '.backup'.  The loops are over new file
    names only; each step is a distributed job."""
    from tallyhawk.sources import files as FS

    results = []
    failed = load_dimensions(wh, sources, run_ts) if sources else {}
    if failed:
        results.append({"error": failed})
    listing = FS.list_files(wh.spark, folder).select(
        "name", X.file_name_date("name").alias("d"), FS.file_kind("name").alias("kind")
    ).filter(F.col("d").isNotNull() & (F.col("kind") != ""))
    loaded = wh.read("meta", "files")
    if loaded is not None:
        listing = listing.join(loaded.select("name"), "name", "left_anti")
    names = sorted((r["d"], r["kind"], r["name"]) for r in listing.collect())
    for day in sorted({d for d, _, _ in names}):
        files: dict[str, list] = {}
        errors = {}
        for d, kind, name in names:
            if d == day:
                try:
                    files.setdefault(kind, []).append((name, read_drop_file(wh.spark, os.path.join(folder, name), kind)))
                except Exception as exc:
                    errors[name] = repr(exc)[:500]
        files = {k: v for k, v in files.items() if v}
        result: dict = {}
        if files:
            try:
                result = run_date(wh, str(day), run_ts, files)
                done = [(name, str(day)) for given in files.values() for name, _ in given]
                wh.append_state("files", wh.spark.createDataFrame(done, "name string, day string"))
                if archive:
                    wh.archive(folder, archive, [name for name, _ in done])
            except Exception as exc:
                errors[str(day)] = repr(exc)[:500]
        results.append({**result, "error": errors} if errors else result)
    return results
