"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates and queries are dealt into blocks by a hash of their id, and every
pair of blocks is one group.  A group sorts its candidates once per dimension.
The lists are read from their best end (from the other end for queries whose
component is negative) by all queries of the group in step.  Every vector that
shows up is scored in full, for the queries still reading at once; a query
stops when the score that an unseen vector could still reach, the sum of its
components times those where the lists stand, is below its kth best.
The best of each block are merged per query by a window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import table

K, EVERY, SCALE = 5, 50, 256
#: Vectors of a candidate block and queries of a query block.
BLOCK, QUERY_BLOCK = 2048, 1024


def whole_components(v: Column, scale: int = SCALE) -> Column:
    return F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(v: Column) -> Column:
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & ok


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def _scoring(m: np.ndarray, q: np.ndarray):
    """Type in which no inner product can round or overflow."""
    most = max(1, *(abs(int(x)) for a in (m, q) if a.size for x in (a.min(), a.max()))) ** 2 * max(1, m.shape[1])
    return float if most < 2**52 else np.int64 if most < 2**62 else object


def _whole(x: np.ndarray) -> np.ndarray:
    """As 64-bit numbers, or the nearest ones."""
    return (np.clip(x, -(2**63), 2**63 - 1) if x.dtype == object else x).astype(np.int64)


def _best(scores: np.ndarray, most: int) -> np.ndarray:
    """Columns of the ``most`` largest scores of each row, of equal ones the first columns."""
    n = scores.shape[1]
    if n <= most:
        return np.broadcast_to(np.arange(n), scores.shape)
    last = np.partition(scores, n - most, axis=1)[:, n - most, None]
    pick, tied = scores > last, scores == last
    room = most - pick.sum(axis=1)
    if (tied.sum(axis=1) > room).any():
        tied &= np.cumsum(tied, axis=1, dtype=np.int32) <= room[:, None]
    return np.nonzero(pick | tied)[1].reshape(-1, most)


def threshold_top(ids: np.ndarray, rows: np.ndarray, m: np.ndarray, queries: np.ndarray, q: np.ndarray, k: int):
    """(query row, id, score) of the k best candidates of every query, ties to
    the smaller id, never the query's own row; scores beyond 64 bits stand for
    the nearest 64-bit number."""
    by_id = np.argsort(ids, kind="stable")
    ids, rows, m = ids[by_id], rows[by_id], m[by_id]
    n, width = m.shape
    kind = _scoring(m, q)
    up = np.argsort(m, axis=0, kind="stable")  # (n, width): smallest first
    values = np.take_along_axis(m, up, axis=0).astype(kind)
    m, q = m.astype(kind), q.astype(kind)
    ahead, behind = np.minimum(q, 0), np.maximum(q, 0)  # parts that read the lists from the smallest, from the largest
    places = {row: i for i, row in enumerate(rows)}
    own = np.array([places.get(row, -1) for row in queries], np.int64)
    best = np.zeros((len(q), 0), np.int64)  # places of the k + 1 best so far, as the own row may be one of them
    score = np.zeros((len(q), 0), np.int64)
    seen, active = np.zeros(n, bool), np.arange(len(q))
    out, depth, step = [], 0, 16
    while len(active):
        to = min(n, depth + step)
        fresh = np.zeros(n, bool)
        fresh[up[depth:to][:, (ahead[active] < 0).any(axis=0)]] = True
        fresh[up[n - to : n - depth][:, (behind[active] > 0).any(axis=0)]] = True
        if not q[active].any(axis=1).all():
            fresh[:] = True  # of a query without components every score is 0
        new = np.flatnonzero(fresh & ~seen)
        seen |= fresh
        if len(new):
            scores = _whole(q[active] @ m[new].T)
            pick = _best(scores, k + 1)
            best = np.concatenate([best, new[pick]], axis=1)
            score = np.concatenate([score, np.take_along_axis(scores, pick, axis=1)], axis=1)
            order = np.lexsort((best, ~score))[:, : k + 1]
            best, score = np.take_along_axis(best, order, axis=1), np.take_along_axis(score, order, axis=1)
        depth, step = to, step * 4
        ended = np.full(len(active), depth == n or bool(seen.all()))
        if not ended.all():
            mine = best == own[active][:, None]
            last = k - 1 + mine[:, :k].any(axis=1)  # where the kth of the others stands
            enough = last < best.shape[1]
            kth = np.take_along_axis(score, np.minimum(last, best.shape[1] - 1)[:, None], axis=1)[:, 0]
            reach = _whole(ahead[active] @ values[to - 1] + behind[active] @ values[n - to])
            ended = enough & (reach < kth)
        for i in np.flatnonzero(ended):
            others = np.flatnonzero(best[i] != own[active[i]])[:k]
            out += [(queries[active[i]], ids[j], int(s)) for j, s in zip(best[i, others], score[i, others])]
        active, best, score = active[~ended], best[~ended], score[~ended]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each query.

    Null vectors, those with null or non-finite components and rows without an
    id take no part.  Shorter vectors count as filled up with zeros.  A row
    repeated with id and vector counts once; rows of one id with different
    vectors are rows of their own, queries and candidates of each other.  Ties
    go to the smaller id.  Components and scores beyond 64 bits stand for the
    nearest 64-bit number.  Other columns are ignored; empty input gives an
    empty result.
    """
    rows = (
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
        .select(F.col(id_col).cast("long").alias("id"), whole_components(F.col(vec_col)).alias("v"), is_query.alias("asks"))
        .dropDuplicates(["id", "v"])
        .withColumn("row", F.md5(F.concat_ws(",", F.col("id"), F.col("v"))))
    )
    n, asked = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))

    def dealt(df, own, own_blocks, other, other_blocks):
        place = F.pmod(F.xxhash64("id"), F.lit(own_blocks)).cast("int").alias(own)
        return df.select("id", "row", "v", place, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other))

    candidates = dealt(rows, "cb", blocks, "qb", query_blocks)
    queries = dealt(rows.where("asks"), "qb", query_blocks, "cb", blocks)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            width = max(map(len, [*left["v"], *right["v"]]))
            found = threshold_top(
                left["id"].to_numpy(), left["row"].to_numpy(object), _matrix(left["v"], width),
                right["row"].to_numpy(object), _matrix(right["v"], width), k,
            )
        out = pd.DataFrame(found, columns=["row", "vec_id", "score"]).astype({"vec_id": "int64", "score": "int64"})
        return out.merge(right[["row", "id"]].rename(columns={"id": "query_id"}), on="row")[["query_id", "row", "vec_id", "score"]]

    best = (
        candidates.groupBy("qb", "cb")
        .cogroup(queries.groupBy("qb", "cb"))
        .applyInPandas(run, "query_id long, row string, vec_id long, score long")
    )
    place = F.row_number().over(Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * x.c[i]))::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
