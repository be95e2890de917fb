"""Current rows of tables that keep older versions of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def current_rows(df: DataFrame, key: str = "id", version: str = "ingested_at") -> DataFrame:
    """One row per ``key``: the one with the greatest ``version``.

    Rows with a null key are dropped, a null version is older than any other,
    and among equal versions (repeats) one row is taken. Select the columns
    that are needed first: the rows are shuffled once by ``key``.
    """
    w = Window.partitionBy(key).orderBy(F.col(version).desc_nulls_last())
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn("_version_rank", F.row_number().over(w))
        .filter(F.col("_version_rank") == 1)
        .drop("_version_rank")
    )
