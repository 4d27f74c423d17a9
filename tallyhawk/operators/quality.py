"""Declared-constraint checks, evaluated as distributed queries.

Each check returns the offending rows (empty DataFrame = constraint holds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Primary key: keys occurring more than once, with their count."""
    k = _keys(key)
    return df.groupBy(*k).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def null_violations(df: DataFrame, columns) -> DataFrame:
    """NOT NULL: per column the number of NULLs (only columns with any)."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    stacked = counts.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in columns])).alias("_s")
    ).select("_s.*")
    return stacked.filter(F.col("n_nulls") > 0)


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    """Foreign key: child rows without a parent (``left_anti``)."""
    ck, pk = _keys(child_key), _keys(parent_key)
    p = parent.select(*[F.col(a).alias("_pk_" + b) for a, b in zip(pk, ck)]).distinct()
    cond = None
    for b in ck:
        term = F.col(b) == F.col("_pk_" + b)
        cond = term if cond is None else cond & term
    return child.join(p, cond, "left_anti")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """String length limits: rows where any column exceeds its limit."""
    cond = None
    for c, n in limits.items():
        term = F.length(F.col(c)) > n
        cond = term if cond is None else cond | term
    return df.filter(cond)


def validity_violations(hist: DataFrame, key, grain: str = "ms", tiebreak=()) -> DataFrame:
    """Non-overlapping validity per key: inverted intervals, overlaps with the
    next version and gaps before it."""
    from tallyhawk.operators.horizon import next_in_key

    k = _keys(key)
    h = next_in_key(hist, k, [C.FROM_COL, *tiebreak], [C.FROM_COL], F.to_date(F.col(C.FROM_COL)), prefix="_nx_")
    h = h.withColumnRenamed("_nx_" + C.FROM_COL, "_next_from")
    frm, to, nxt = F.col(C.FROM_COL), F.col(C.TO_COL), F.col("_next_from")
    issue = (
        F.when(to < frm, F.lit("inverted"))
        .when(nxt.isNotNull() & (nxt <= to), F.lit("overlap"))
        .when(nxt.isNotNull() & (nxt > X.shift(to, grain, 1)), F.lit("gap"))
    )
    return h.withColumn("issue", issue).filter(F.col("issue").isNotNull()).drop("_next_from")


def length_report(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Per constrained text column: longest value, its limit and the number
    of values over the limit (one aggregate pass)."""
    aggs = []
    for c, n in limits.items():
        aggs += [F.max(F.length(F.col(c))).alias(f"_max_{c}"), F.sum((F.length(F.col(c)) > n).cast("long")).alias(f"_over_{c}")]
    row = df.agg(*aggs)
    items = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_max_{c}").cast("long").alias("max_length"), F.lit(n).alias("length_limit"),
                 F.coalesce(F.col(f"_over_{c}"), F.lit(0).cast("long")).alias("n_over"))
        for c, n in limits.items()
    ]
    return row.select(F.explode(F.array(*items)).alias("_s")).select("_s.*")


def null_report(df: DataFrame, columns) -> DataFrame:
    """NULL count of every listed column (one aggregate pass)."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    items = [F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0).cast("long")).alias("n_nulls")) for c in columns]
    return counts.select(F.explode(F.array(*items)).alias("_s")).select("_s.*")
