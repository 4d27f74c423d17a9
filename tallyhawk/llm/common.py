"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a lookup table (of at most a few kB a row) is broadcast;
#: larger ones are joined by shuffle, where AQE splits skewed partitions.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows a task of a derived small table is given at least.
ROWS_PER_TASK = 20_000


def tasks_for(rows: int) -> int:
    """Tasks for a table of so many rows: they grow with it."""
    return max(8, -(-rows // ROWS_PER_TASK))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Where it is unset, a
    folder of our own in local mode; on a cluster, whose machines share no
    temporary folder, an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master or "").startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-cp-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def gathered(df: DataFrame, n: int) -> DataFrame:
    """:func:`cut` into n files, for tables of small rows: as many tasks as
    before compute them, then they are dealt out anew.  A checkpoint has a file
    for each partition, which may be many more than its rows call for; each
    costs its writer system calls (on a local file system processes of their
    own) and every later step a task."""
    return cut(df.repartition(n))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcast tables of finished
    steps: it does so once the driver's garbage collector finds them unused,
    which by itself may be half an hour later; until then every executor keeps
    a memory page or more for each broadcast table.  For jobs of many steps,
    between the steps."""
    spark.sparkContext._jvm.System.gc()


def join_lookup(
    big: DataFrame, lookup: DataFrame, on, how: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``lookup`` (already cut) to ``big``: by broadcast only if a count
    shows at most ``max_rows`` rows, else by shuffle."""
    if lookup.limit(max_rows + 1).count() <= max_rows:
        lookup = F.broadcast(lookup)
    return big.join(lookup, on, how)


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def sample_labelled(
    df: DataFrame, id_col: str, label: str, per_label: int
) -> DataFrame:
    """(id, label) of about ``per_label`` rows of each non-null label: those
    whose id hashes below per_label / (rows of that label); of an id with
    several labels the smallest counts.  One counting
    aggregate and a filter: no window, no sort, and no group in one task."""
    ids = df.select(F.col(id_col).alias("sample_id"), F.col(label).alias("sample_label")).where(
        "sample_id is not null and sample_label is not null"
    )
    counts = ids.groupBy("sample_label").agg(F.count("*").alias("rows"))
    share = F.pmod(F.xxhash64("sample_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (
        ids.join(F.broadcast(counts), "sample_label")
        .where(share * F.col("rows") < per_label)
        .groupBy("sample_id")
        .agg(F.min("sample_label").alias("sample_label"))
    )


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared checkpoint folder, for
    tables of which later steps read few columns."""
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b), root being
    the smallest node reachable: alternating large-star and small-star steps,
    each a few shuffles of the edges, until every node has one edge and no root has one."""
    n = tasks_for(links.count())  # the edges only get fewer
    edges = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(n)
    )
    while True:
        release(links.sparkSession)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(n).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = cut(small.union(least.select("a", F.col("m").alias("b"))).coalesce(n).distinct().coalesce(n))
        own = edges.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("c")).coalesce(n)
        chained = edges.select(F.col("b").alias("a")).distinct().join(own, "a", "left_semi").select("a")
        if own.where("b <> c").select("a").union(chained).coalesce(n).isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
