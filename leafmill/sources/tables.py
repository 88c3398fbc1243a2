"""Tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a plain scan over all cores where their files split into fewer partitions than that; else as they are.

    For scans only: to count the partitions of anything with a shuffle Spark would run it.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
