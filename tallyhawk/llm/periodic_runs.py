"""Periodic runs of words by an online sparse diagonal DP.

Word i and its earlier occurrence i - q lie on the diagonal of lag q.  The DP
goes through the words in order; the earlier occurrence of a word adds one to
the match length of its lag, and a lag that ends with a sufficient length is
emitted as a run.  Two facts keep the active lags sparse and the work within
(words x log words), however often a word occurs:

* A run of period q with at least max(24, 3q) words matches itself at lag q
  over at least 2q and at least 16 words.  So for q below 16 only matches of
  whole 16-word windows count, for 16 <= q < 32 those of 32 words, for
  32 <= q < 64 those of 64 words, and so on.  Windows that occur once in the
  text are dropped; the windows of twice the length are made from the pairs of
  those left (equal numbers mean equal words: no hashes).
* Among the earlier occurrences of a window only the nearest can have the lag
  of a run.  If the nearest had a lag d < q, the window and what lies d before
  it would have both periods over q + d words or more, hence period
  gcd(d, q) < q, and q would not be the smallest period of the run.

So each window adds to one lag at most.  The words at which one lag goes on
without a gap are one run, maximal on both sides, with q its smallest period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import table
from tallyhawk.llm.sentencepiece import runs as text_runs
from tallyhawk.llm.words import split_words

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the smallest window: what a run of any period matches itself over.
_WINDOW = 16


def _numbered(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows (key, at), at ascending, those whose key occurs twice or
    more: at, a number per key, and the lag to the nearest earlier one (0: none)."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(~same[:-1]) - 1
    lag = np.zeros(len(key), np.int64)
    lag[order[1:]] = np.where(same[1:-1], at[order[1:]] - at[order[:-1]], 0)
    often = np.empty(len(key), bool)
    often[order] = same[:-1] | same[1:]
    return at[often], number[often], lag[often]


def find_runs(codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs by text, start and period.
    ``codes`` are the words of all texts, ``firsts`` where each text starts."""
    n = len(codes)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at, number, _ = _numbered(text * (codes.max(initial=0) + 1) + codes, np.arange(n))
    size, found = 1, []
    whole = np.full(n, -1, np.int64)  # number of the window that starts here
    while len(at):
        whole[:] = -1
        whole[at] = number
        there = at + size
        ok = there < n
        ok[ok] = (text[at[ok]] == text[there[ok]]) & (whole[there[ok]] >= 0)
        at, a, b = at[ok], number[ok], whole[there[ok]]
        size *= 2
        at, number, lag = _numbered(a * (number.max(initial=0) + 1) + b, at)
        if size < _WINDOW or not len(at):
            continue
        goes = lag >= (1 if size == _WINDOW else size // 2)
        goes &= lag < size
        here, q = at[goes], lag[goes]
        if len(here):
            begins = np.ones(len(here), bool)
            begins[1:] = (here[1:] != here[:-1] + 1) | (q[1:] != q[:-1])
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(here)) - 1
            start = here[first] - q[first]
            found.append(np.stack([start, here[last] + size - start, q[first]]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = np.concatenate(found, axis=1)
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return text[start], start - firsts[text[start]], length, period


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then
    period) and collapsed (the text's words joined by one space, without those
    that repeat a run's first period) of every row.

    Words are runs without ASCII white space, numbered from 0.  A null or
    empty text has no words, no runs and an empty collapsed text.  Repeated
    rows are handled on their own; an empty table gives an empty result; other
    columns are ignored, whatever their names.  Texts of any length are
    handled whole: memory grows with the longest text only.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in text_runs(batch, "text"):
                words = split_words(part.column("text"))
                text, start, length, period = find_runs(words.codes, words.firsts)
                change = np.zeros(len(words.codes) + 1, np.int64)
                begin = words.firsts[text] + start
                np.add.at(change, begin + period, 1)
                np.add.at(change, begin + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                ends = np.concatenate([[0], np.cumsum(kept)])[words.firsts]
                said = words.distinct.cast(pa.string()).take(pa.array(words.codes[kept]))
                counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=part.num_rows))])
                struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(words.firsts), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), struct),
                        pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), said), " "),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")


def planted(df: DataFrame) -> DataFrame:
    """doc_id and text, where the texts of the documents that the query's
    contract names repeat a stretch of their own words to their end (a null id
    names none)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda x: x != "")
    made = df.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    made = made.select("doc_id", "text", "w", n.alias("n"), g.alias("g"), F.when(n > 0, g % n).alias("a"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    made = made.select("doc_id", "text", "w", "n", F.col("a").cast("int").alias("a"), p.alias("p"))
    stretch = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    rest = F.slice(F.flatten(F.array_repeat(stretch, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), rest), " ")
    return made.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query's contract, from :func:`periodic_runs`."""
    none = F.lit(None).cast(RUN)
    best = F.aggregate(
        "runs", none,
        lambda t, r: F.when(t.isNull() | (r["length"] * t["period"] > t["length"] * r["period"]), r).otherwise(t),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    length, period = F.col("best.length"), F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(F.array_join("lines", "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(periodic_runs(planted(table(spark, sf_dir, "documents"))))


#: The runs of a text can't be put in SQL at a bearable cost; tests hold them against brute force.
ORACLE_SQL = None
