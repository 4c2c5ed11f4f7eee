"""Parquet tables and temporary views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 256 * 1024 * 1024


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, max_bytes: int = SPREAD_BYTES) -> DataFrame:
    """Deal the rows of a small table out to all cores; leave a large one alone.

    A scan cannot split a Parquet row group, so a small file is often read by one task,
    which then also does all the row work up to the next shuffle. For texts to be cut up
    that costs far more than moving them. A large table has row groups enough.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > max_bytes:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def register_views(spark: SparkSession, directory: str, names: Iterable[str]) -> None:
    """Make tables addressable by name from ``spark.sql``."""
    for name in names:
        read_table(spark, directory, name).createOrReplaceTempView(name)
