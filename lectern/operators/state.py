"""What is done, what failed, and what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``work`` without a row in ``done``; null keys are never done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def completion(work: DataFrame, done: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """group, n, n_done, complete: a group is complete if all its work is done."""
    d = done.select(*keys).distinct().withColumn("_done", F.lit(1))
    j = work.select(*keys).distinct().join(d, keys, "left")
    g = j.groupBy(group).agg(F.count("*").alias("n"), F.count("_done").alias("n_done"))
    return g.withColumn("complete", F.col("n") == F.col("n_done"))


def standing_failures(log: DataFrame, key: str, order: str, failed, succeeded) -> DataFrame:
    """key, n, last: failures after the key's last success. ``order`` decides; a success at the same place clears."""
    ok = log.filter(succeeded).groupBy(F.col(key).alias("_k")).agg(F.max(order).alias("_ok"))
    bad = log.filter(failed).join(ok, F.col(key) == F.col("_k"), "left").filter(F.col("_ok").isNull() | (F.col(order) > F.col("_ok")))
    return bad.groupBy(key).agg(F.count("*").alias("n"), F.max(order).alias("last"))
