"""Line dedup by site-relative frequency: group by site, divide the pages that
contain a line by the site's pages, drop lines above a boilerplate ratio.

The frequent lines of a site are few whatever its size: their page counts sum
to at most (lines of all pages), so a site has at most (mean lines per page) /
ratio of them.  They come back to the pages as one array per site; the texts
themselves are never shuffled while that table is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, join_lookup, table

#: A line on more than this share of a site's pages is boilerplate.
RATIO = 0.02
#: And on so many of its pages at least, which a pair of copies can't reach.
LEAST_PAGES = 3


def _lines(text_col: str):
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)


def _key(line):
    return F.trim(line)


def boilerplate_lines(df: DataFrame, site: str, text_col: str, ratio: float, least: int) -> DataFrame:
    """site, lines (array of the md5 of every boilerplate line): counts are
    combined in each task before the shuffle on (site, line hash)."""
    pages = df.select(F.col(site).alias("site"), _lines(text_col).alias("l"))
    totals = pages.groupBy("site").agg(F.count("*").alias("pages"))
    keys = F.array_distinct(F.transform(F.filter("l", lambda x: _key(x) != ""), lambda x: F.unhex(F.md5(_key(x)))))
    counts = (
        pages.select("site", F.explode(keys).alias("line"))
        .groupBy("site", "line")
        .agg(F.count("*").alias("on"))
        .where(F.col("on") >= least)
    )
    both = join_lookup(counts, cut(totals).withColumnRenamed("site", "t_site"), F.col("site").eqNullSafe(F.col("t_site")), "inner")
    return (
        both.where(F.col("on") > F.lit(ratio) * F.col("pages"))
        .groupBy("site")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_frequent_lines(
    df: DataFrame,
    site: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
) -> DataFrame:
    """``df`` with text without its site's boilerplate lines, n_lines and
    n_dropped (columns of these names are replaced).

    A line is boilerplate on more than ``ratio`` of its site's pages and on
    ``least`` of them at least, whatever the size of the site.  Lines are compared trimmed of spaces; blank lines are never counted nor
    dropped.  A line repeated inside a page counts once for that page and all
    its repeats go.  A null text stays null (0 lines); a null site is a site
    of its own.  Repeated rows are pages of their own.
    """
    found = cut(boilerplate_lines(df, site, text_col, ratio, least)).select(
        F.col("site").alias("found_site"), F.col("lines").alias("found_lines")
    )
    rows = df.select(
        F.struct(*[c for c in df.columns if c not in (text_col, "n_lines", "n_dropped")]).alias("whole"),
        F.col(site).alias("row_site"),
        F.col(text_col).alias("row_text"),
    )
    joined = join_lookup(rows, found, F.col("row_site").eqNullSafe(F.col("found_site")), "left", 2_000)
    kept = F.filter(
        _lines("row_text"), lambda x: ~F.array_contains(F.col("found_lines"), F.unhex(F.md5(_key(x)))) | (_key(x) == "")
    )
    out = F.when(F.col("found_lines").isNull(), _lines("row_text")).otherwise(kept)
    n = F.when(F.col("row_text").isNull(), 0).otherwise(F.size(_lines("row_text"))).cast("long")
    made = joined.select("whole", "row_text", out.alias("out"), n.alias("n_lines"))
    return made.select(
        "whole.*",
        F.when(F.col("row_text").isNotNull(), F.array_join("out", "\n")).alias(text_col),
        "n_lines",
        F.when(F.col("row_text").isNull(), 0).otherwise(F.col("n_lines") - F.size("out")).cast("long").alias("n_dropped"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_frequent_lines(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, source, i, ls[i] AS line, trim(ls[i], ' ') AS k
  FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT l.source, l.k FROM l JOIN pages p ON l.source IS NOT DISTINCT FROM p.source WHERE l.k <> ''
  GROUP BY l.source, l.k, p.pages HAVING count(DISTINCT doc_id) >= {LEAST_PAGES} AND count(DISTINCT doc_id) > {RATIO} * p.pages),
r AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE b.k IS NULL) AS text,
         count(*) AS n_lines, count(b.k) AS n_dropped
  FROM l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.k = b.k GROUP BY l.doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE r.n_lines END AS n_lines,
       CASE WHEN d.text IS NULL THEN 0 ELSE r.n_dropped END AS n_dropped
FROM documents d JOIN r USING (doc_id)
"""
