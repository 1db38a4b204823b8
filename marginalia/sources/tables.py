"""Documents from table storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TASKS_PER_CORE = 3


def partition_floor(df: DataFrame, floor: int | None = None) -> DataFrame:
    """At least ``floor`` partitions (default: three per core of the cluster).

    A corpus in a few large row groups would leave cores idle; a large corpus
    has more splits than cores and passes through without a shuffle.
    """
    floor = floor or TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(floor) if df.rdd.getNumPartitions() < floor else df


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Named columns of ``<folder>/<name>.parquet``."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
