"""Relational sources read through Spark's JDBC data source.

The incremental predicate is an OR of plain comparisons, so the JDBC scan
receives it as pushed filters; only the key column is read for delete
detection (column pruning reaches the scan).  Large tables are read in
parallel with ``partitionColumn`` bounds; where the caller names only the
column, one min/max query gives the bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhawk.functions import constants as C
from tallyhawk.operators.state import incremental_filter


def column_bounds(spark: SparkSession, url: str, table: str, column: str, properties: dict | None = None) -> tuple:
    """Smallest and largest value of a source column (None, None if it has
    none), computed by the source."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    return tuple(read_table(spark, url, query, properties).first())


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Full read of a source table (first load).  With ``partition_column`` (a
    number, date or timestamp) it is read in ranges between the bounds, by
    default the column's own smallest and largest value; rows outside them or
    without a value are read too."""
    if partition_column and lower_bound is None and upper_bound is None:
        lower_bound, upper_bound = column_bounds(spark, url, table, partition_column, properties)
        if lower_bound is None:
            partition_column = None
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 8))
        )
    return reader.load()


def source_columns(df: DataFrame, table: str) -> DataFrame:
    """Rename source columns to warehouse names (positional mapping)."""
    mapping = C.SOURCE_COLUMNS[table]
    cols = [df[s].alias(t) for s, t in mapping]
    extra = [df[c] for c in (C.CREATE_COL, C.UPDATE_COL) if c in df.columns]
    return df.select(*cols, *extra)


def read_changes(spark: SparkSession, url: str, table: str, watermark, properties: dict | None = None, **kw) -> DataFrame:
    """Rows changed since ``watermark`` (all rows when it is None)."""
    df = read_table(spark, url, table, properties, **kw)
    if watermark is not None:
        df = df.filter(incremental_filter(watermark))
    return df


def read_keys(spark: SparkSession, url: str, table: str, key: str, properties: dict | None = None, **kw) -> DataFrame:
    """The full key list of a source table (for delete detection)."""
    return read_table(spark, url, table, properties, **kw).select(key)
