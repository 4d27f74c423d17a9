"""Daily file drops as a Structured Streaming file source.

The stream's checkpoint remembers which files were processed, so a file is
loaded exactly once even when the job is started every few minutes
(``Trigger.AvailableNow`` processes what is there and stops).  Processed
files can be archived by the source itself (``cleanSource=archive``).  Each
micro-batch goes through ``foreachBatch`` into idempotent warehouse writes,
so a batch replayed after a failure rewrites the same partitions.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhawk.functions import columns as X
from tallyhawk.sources import files as FS

FILE_NAME = "_file_name"


def file_stream(
    spark: SparkSession,
    folder: str,
    prefix: str,
    schema,
    archive_dir: str | None = None,
    sep: str = ";",
    max_files_per_trigger: int = 100,
) -> DataFrame:
    """Stream the CSV files named ``<prefix>_DDMMYYYY*`` in ``folder``.

    Adds the file name and the file date taken from it.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("pathGlobFilter", f"{prefix}_*")
    )
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.option("maxFilesPerTrigger", str(max_files_per_trigger)).csv(folder)
    return df.withColumn(FILE_NAME, F.col("_metadata.file_name")).withColumn(
        "file_date", X.file_name_date(F.col(FILE_NAME))
    )


def transactions_stream(spark: SparkSession, folder: str, archive_dir: str | None = None) -> DataFrame:
    """Daily transaction files, normalised to warehouse columns + file_date/_file_name."""
    raw = file_stream(spark, folder, "transactions", FS.TRANSACTION_CSV_SCHEMA, archive_dir)
    return FS.normalize_transactions(raw, keep=["file_date", FILE_NAME])


def run_available(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    checkpoint_location: str,
    query_name: str | None = None,
) -> StreamingQuery:
    """Process every file available now through ``process`` and stop."""
    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    q.awaitTermination()
    return q


def terminals_stream(spark: SparkSession, folder: str, archive_dir: str | None = None) -> DataFrame:
    """Daily full terminal snapshots, one file per micro-batch: snapshots are
    merged in arrival order, each as of its file date."""
    return file_stream(spark, folder, "terminals", FS.TERMINAL_SCHEMA, archive_dir, max_files_per_trigger=1)


def blacklist_stream(spark: SparkSession, folder: str, archive_dir: str | None = None) -> DataFrame:
    """Month-to-date blacklist files (date; passport)."""
    raw = file_stream(spark, folder, "passport_blacklist", FS.BLACKLIST_SCHEMA, archive_dir)
    return raw.withColumnRenamed("passport", "passport_num")
