"""Readers of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.session import ship


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread``: for long work on each row, a table of fewer scan tasks than there are cores is dealt over all."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df
