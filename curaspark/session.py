"""A session with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(name: str = "curaspark", **settings: str) -> SparkSession:
    """A SparkSession in UTC with ANSI checks and adaptive execution; master, memory and partitions are the cluster's own."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Texts can be long: a batch for Python holds few rows.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    )
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """df (files under projections) dealt anew over the cores, if it has few splits of which one or a few hold the rows, as files of one
    row group have; a table of more splits than four for each core is left alone, so what is shuffled is small."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores < 2 or df._jdf.queryExecution().toRdd().getNumPartitions() > 4 * cores:
        return df
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]  # at most four for each core
    return df.repartition(cores) if rows and max(rows) * cores > 3 * sum(rows) else df
