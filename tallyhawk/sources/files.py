"""File sources: daily transaction CSVs, full snapshots, month-to-date files,
and discovery of file dates from names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhawk.functions import columns as X
from tallyhawk.functions import constants as C

# Positional layout of the daily transaction file (';' separated, header).
TRANSACTION_CSV_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("transaction_date", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("card_num", T.StringType()),
        T.StructField("oper_type", T.StringType()),
        T.StructField("oper_result", T.StringType()),
        T.StructField("terminal", T.StringType()),
    ]
)

TERMINAL_SCHEMA = T.StructType(
    [
        T.StructField("terminal_id", T.StringType()),
        T.StructField("terminal_type", T.StringType()),
        T.StructField("terminal_city", T.StringType()),
        T.StructField("terminal_address", T.StringType()),
    ]
)

BLACKLIST_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("passport", T.StringType())]
)


def normalize_transactions(raw: DataFrame, keep=()) -> DataFrame:
    """Positional CSV columns -> warehouse transaction columns (``keep``:
    extra columns carried through unchanged).

    The decimal comma of ``amount`` is replaced before the cast (a direct
    cast of '5000,50' fails in ANSI mode); card numbers are right-trimmed
    (fixed-width source fields); empty cells become NULL.
    """
    cols = raw.columns
    return raw.select(
        F.trim(F.col(cols[0])).alias("trans_id"),
        X.trunc_ms(F.to_timestamp_ntz(F.col(cols[1]))).alias("trans_date"),
        X.normalize_amount(F.col(cols[2])).alias("amt"),
        F.rtrim(F.col(cols[3])).alias("card_num"),
        F.col(cols[4]).alias("oper_type"),
        F.col(cols[5]).alias("oper_result"),
        F.col(cols[6]).alias("terminal"),
        *[F.col(c) for c in keep],
    )


def read_transactions_csv(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_CSV_SCHEMA) -> DataFrame:
    """Read daily transaction files (``;``, header) with an explicit schema."""
    raw = spark.read.schema(schema).option("sep", ";").option("header", True).csv(path)
    return normalize_transactions(raw)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = TERMINAL_SCHEMA,
                  sep: str = ";") -> DataFrame:
    """Read a full snapshot (CSV with header, or Parquet)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def read_accumulating(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = BLACKLIST_SCHEMA,
                      sep: str = ";") -> DataFrame:
    """Read a month-to-date file (all rows; slice with
    :func:`tallyhawk.operators.facts.slice_accumulating`)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def file_dates(names: DataFrame, name_col: str = "name") -> DataFrame:
    """Distinct dates embedded in file names (8 digits, DDMMYYYY) with the
    number of files per date; sort by ``date_point`` for processing order
    (chronological, not by the text)."""
    d = names.select(F.col(name_col).alias("name")).filter(F.col("name").rlike(C.FILE_DATE_REGEX))
    d = d.select("name", X.file_name_date("name").alias("date_point")).filter(F.col("date_point").isNotNull())
    return d.groupBy("date_point").agg(F.countDistinct("name").alias("n_files"))


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """File names in a folder, listed by Spark (the content column is pruned,
    so files are not read)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select(F.element_at(F.split(F.col("path"), "/"), -1).alias("name"))


def discover_file_dates(spark: SparkSession, folder: str) -> DataFrame:
    return file_dates(list_files(spark, folder))


def file_kind(name_col: str = "name"):
    """'transactions' / 'passport_blacklist' / 'terminals' from a file name."""
    return F.regexp_extract(F.col(name_col), "^(transactions|passport_blacklist|terminals)_", 1)
