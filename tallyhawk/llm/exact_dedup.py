"""Exact dedup: group by 128-bit content hash, keep the smallest stable id,
compare bytes inside groups to exclude collisions.  DataFrame functions only.

Grouping on (hash, normalised bytes) is the byte comparison: the hash decides
where rows go, equality of the bytes decides who is grouped.  The counts are
combined before the shuffle, so a text that a third of all rows share leaves
each task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import table

#: Characters deleted before texts are compared: \x20 and \x09-\x0D.
WHITE = " \t\n\x0b\x0c\r"
#: Repeats of a row dealt out at a time.
_LOT = 100_000


def _digested(df: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """doc_id, n (code points), tie (hash of the original text) and norm."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n"),
        F.xxhash64(text).alias("tie"),
        F.translate(text, WHITE, "").alias("norm"),
        *more,
    )


def text_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: text_sha256, group_size, keep_id,
    keep_n and keep_tie (id, code points and text hash of the row that stays:
    the longest original text, then the smallest id, null ids last, then the
    larger hash)."""
    rows = _digested(df, id_col, text_col).withColumn("h", F.unhex(F.md5("norm")))
    return (
        rows.groupBy("h", "norm")
        .agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("n", F.bitwise_not("doc_id").alias("neg"), "tie")).alias("best"),
        )
        .select(
            F.sha2("norm", 256).alias("text_sha256"),
            "group_size",
            F.bitwise_not("best.neg").alias("keep_id"),
            F.col("best.n").alias("keep_n"),
            F.col("best.tie").alias("keep_tie"),
        )
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decision for every row: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal to each other and form one group.  Ties go
    to the smallest id; a null id loses to any other; rows of one id are told
    apart by their original text.  Of rows that repeat id and text of the one
    that stays, one says kept = true.  Other columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    # repeated rows are one with a count, so the one that stays can say so once
    rows = (
        _digested(df, id_col, text_col)
        .select("doc_id", "n", "tie", F.sha2("norm", 256).alias("text_sha256"))
        .groupBy("doc_id", "n", "tie", "text_sha256")
        .agg(F.count("*").alias("times"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n")) & (F.col("tie") == F.col("keep_tie"))
    placed = rows.join(text_groups(df, id_col, text_col), "text_sha256").withColumn("same", same)
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {_LOT}"))).alias("lot")
    in_lot = F.sequence(F.lit(1).cast("long"), F.least(F.lit(_LOT).cast("long"), F.col("times") - F.col("lot") * _LOT))
    return (
        placed.select("*", lots)
        .select("*", F.explode(in_lot).alias("time"))
        .select("doc_id", "keep_id", "group_size", (F.col("same") & (F.col("lot") == 0) & (F.col("time") == 1)).alias("kept"), "text_sha256")
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without copies: all columns of the row that stays of each group.
    Rows are matched by id and text; repeated rows give one row."""
    keep = text_groups(df, id_col, text_col).select(
        F.col("keep_id").alias("k_id"), F.col("keep_n").alias("k_n"), F.col("keep_tie").alias("k_tie"), F.col("text_sha256").alias("k_sha")
    )
    rows = _digested(df, id_col, text_col, F.struct(*df.columns).alias("whole")).select(
        "doc_id", "n", "tie", "whole", F.sha2("norm", 256).alias("sha")
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("sha") == F.col("k_sha"))
        & (F.col("n") == F.col("k_n")) & (F.col("tie") == F.col("k_tie"))
    )
    return (
        rows.join(keep, same, "left_semi")
        .groupBy("doc_id", "sha")
        .agg(F.min("whole").alias("whole"))
        .select("whole.*")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
