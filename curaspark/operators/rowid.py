"""Row positions: order is explicit, never implied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = "row_pos"


def scanned(df: DataFrame, name: str = ROW) -> DataFrame:
    """df with a position that follows the order of a single file, read just before (CSV, text, xlsx)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def parquet(df: DataFrame, name: str = ROW) -> DataFrame:
    """df with the row's index in its Parquet file; with several files, order by the file's name first (see file_of)."""
    return df.select("*", F.col("_metadata.row_index").alias(name))


def file_of(df: DataFrame, name: str = "file") -> DataFrame:
    """df with the path of the file that each row comes from."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def in_order(df: DataFrame, name: str = ROW) -> DataFrame:
    """df sorted by position, without it: for sinks only."""
    return df.orderBy(name).drop(name)


def head(df: DataFrame, n: int, name: str = ROW) -> DataFrame:
    """The first n rows by position, for reports."""
    return df.orderBy(name).limit(n)
