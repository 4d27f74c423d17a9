"""SparkSession construction and session-level settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on.  AQE re-plans joins from the
# real shuffle statistics (runtime broadcast only below the size threshold,
# skew-join splitting, partition coalescing); UTC keeps timestamp_ntz <->
# timestamp conversions exact.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (100 TB of facts, ~1000 executors).  Shuffles
# start with many partitions and AQE coalesces them towards the advisory size,
# so one setting fits both a daily run and a full backfill; skewed join
# partitions (a card with a huge share of operations) are split at runtime;
# runtime broadcast only below a measured 64 MB; tasks are retried when
# executors are lost.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def get_session(
    master: str | None = None,
    app: str = "tallyhawk",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
    profile: str = "local",
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings
    (``profile='cluster'`` adds :data:`CLUSTER_CONF`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if profile == "cluster":
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    None where it is unset (tests set it themselves).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` by a reliable checkpoint and drop its lineage.  Local
    sessions without ``spark.checkpoint.dir`` get a folder of their own; on a
    cluster, whose machines share no temporary folder, that is an error."""
    spark = df.sparkSession
    if checkpoint_dir(spark) is None:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="th-cp-"))
    return df.checkpoint(eager=True)
