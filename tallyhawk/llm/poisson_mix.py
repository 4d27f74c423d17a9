"""Mixing sources to target weights by Poisson replication.  DataFrame
functions only.

A source of size s that should make up weight w of a corpus of T code points
is repeated w * T / s times on average.  Each document draws its own count:
the first 52 bits of md5(seed, id) give a uniform u in [0, 1), and the count
is the number of steps of the source's Poisson distribution function that u
has passed.  Drawing depends on the id and the seed alone, so a lost task
draws the same counts again.  The copies are shuffled globally by the md5 of
(seed, id, copy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, join_lookup, table

SEED = "mix-1"
#: Without explicit weights a source's weight is its size to this power:
#: 1 keeps the shares as they are, 0 makes every source equal.
ALPHA = 0.5


def _hash(seed: str, *cols) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def repetition_rates(df: DataFrame, weights: dict | None, alpha: float) -> DataFrame:
    """source, size, rate (mean copies of a document), steps (the Poisson
    distribution function up to 12 deviations above the mean): one row per
    source, from sums that are combined before the shuffle."""
    sizes = df.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("size"))
    if weights is None:
        weighted = sizes.withColumn("w", F.round(F.pow(F.col("size").cast("double"), F.lit(alpha)) * 1e6).cast("long"))
    else:
        pairs = df.sparkSession.createDataFrame(
            [(k, round(v * 1e6)) for k, v in weights.items()], "name string, w long"
        )
        weighted = sizes.join(pairs, sizes["source"].eqNullSafe(pairs["name"]), "left").select(
            "source", "size", F.coalesce("w", F.lit(0)).alias("w")
        )
    total = weighted.agg(F.sum("w").alias("all_w"), F.sum("size").alias("all_size"))
    rate = F.when(
        (F.col("size") > 0) & (F.col("all_w") > 0),
        F.col("w").cast("double") * F.col("all_size").cast("double") / F.col("all_w").cast("double") / F.col("size").cast("double"),
    ).otherwise(F.lit(1.0))
    rated = weighted.join(F.broadcast(total)).select("source", "size", rate.alias("rate"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 20).cast("int")
    # log P(k) = log P(k-1) + log(rate) - log(k); sums of exp give the steps
    steps = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(
            (-F.col("rate")).alias("lp"),
            F.exp(-F.col("rate")).alias("c"),
            F.array(F.exp(-F.col("rate"))).alias("out"),
        ),
        lambda a, k: F.struct(
            (a["lp"] + F.log("rate") - F.log(k.cast("double"))).alias("lp"),
            (a["c"] + F.exp(a["lp"] + F.log("rate") - F.log(k.cast("double")))).alias("c"),
            F.concat(
                a["out"], F.array(a["c"] + F.exp(a["lp"] + F.log("rate") - F.log(k.cast("double"))))
            ).alias("out"),
        ),
        lambda a: a["out"],
    )
    none = F.array(F.lit(1.0))  # rate 0: u never reaches the first step
    return rated.select("source", "size", "rate", F.when(F.col("rate") > 0, steps).otherwise(none).alias("steps"))


def poisson_mix(
    df: DataFrame,
    weights: dict | None = None,
    alpha: float = ALPHA,
    seed: str = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """Every column of ``df`` with copy (1..count) and mix_key, one row per
    copy, in the order of mix_key inside partitions dealt by mix_key.

    ``weights`` maps source to weight (sources it doesn't name get 0: no
    copies); None derives them from ``alpha``.  A null source is a source of
    its own; a null or empty text has size 0, and a source without any text
    keeps the rate 1.  A null id draws as the empty id.  Rows with equal ids
    draw equal counts.  Columns of ``df`` named copy or mix_key are replaced.
    """
    rates = cut(repetition_rates(df, weights, alpha)).select(
        F.col("source").alias("rate_source"), F.col("steps").alias("rate_steps")
    )
    rows = df.select(
        F.struct(*[c for c in df.columns if c not in ("copy", "mix_key")]).alias("whole"),
        F.col(id_col).alias("mix_id"),
        F.col("source").alias("mix_source"),
    )
    u = F.conv(F.substring(_hash(seed, "mix_id"), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))
    drawn = join_lookup(rows, rates, F.col("mix_source").eqNullSafe(F.col("rate_source")), "inner").withColumn(
        "count", F.size(F.filter("rate_steps", lambda c: u >= c))
    )
    copies = drawn.where("count > 0").select("whole", "mix_id", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    out = copies.withColumn("mix_key", _hash(seed, "mix_id", "copy"))
    return out.repartition("mix_key").sortWithinPartitions("mix_key").select("whole.*", "copy", "mix_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(table(spark, sf_dir, "documents"))


#: Sizes, rates and draws as above, from `documents` or any table like it.
MIX_SQL = r"""
  SELECT d.*, c.copy, md5('{seed}|' || coalesce(d.doc_id::VARCHAR, '') || '|' || c.copy) AS mix_key
  FROM (
    SELECT d.*, len(list_filter(r.steps, lambda s: d.u >= s)) AS mix_count
    FROM (
      SELECT *, ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
      FROM {src}) d
    JOIN (
      SELECT source, list_transform(range(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT + 1), lambda k:
        list_sum(list_transform(range(0, k + 1), lambda j: exp(-rate + j * ln(rate) - lgamma(j + 1.0))))) AS steps
      FROM (
        SELECT source, CASE WHEN size > 0 THEN w::DOUBLE * (sum(size) OVER ())::DOUBLE / (sum(w) OVER ())::DOUBLE / size::DOUBLE ELSE 1.0 END AS rate
        FROM (
          SELECT source, size, round(pow(size::DOUBLE, {alpha}) * 1e6)::BIGINT AS w
          FROM (SELECT source, sum(length(coalesce(text, '')))::BIGINT AS size FROM {src} GROUP BY source)))) r
    ON d.source IS NOT DISTINCT FROM r.source) d,
  LATERAL (SELECT unnest(range(1, mix_count + 1))::INTEGER AS copy) c
"""

ORACLE_SQL = (
    "SELECT * EXCLUDE (u, mix_count) FROM ("
    + MIX_SQL.format(seed=SEED, alpha=ALPHA, src="documents")
    + ")"
)
