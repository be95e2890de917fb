"""Sinks: partitioned writes, replacing a group's rows, upserts, reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.operators.ordered import numbered


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """One folder per value of ``by``; a hot value is spread over several files."""
    df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def replace_groups(df: DataFrame, path: str, by: str) -> None:
    """Replace the rows of the groups in ``df`` and leave all others: doing it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert(base: DataFrame, updates: DataFrame, key: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """``base`` with the rows of ``updates`` in place of those of the same key, and its new keys.

    ``keep``: columns that an update takes from the base row where it has none
    itself. Keys are unique on both sides; null keys are dropped.
    """
    b = base.filter(F.col(key).isNotNull()).select(F.struct(*base.columns).alias("b"), F.col(key).alias("_k"))
    u = updates.filter(F.col(key).isNotNull()).select(F.struct(*base.columns).alias("u"), F.col(key).alias("_k"))
    j = b.join(u, "_k", "full")
    return j.select(
        *[
            (F.coalesce(f"u.{c}", f"b.{c}") if c in (keep or ()) else F.when(F.col("u").isNotNull(), F.col(f"u.{c}")).otherwise(F.col(f"b.{c}"))).alias(c)
            for c in base.columns
        ]
    )


def markdown_lines(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """line_no, line: a Markdown table; bars within cells are escaped, nulls are empty."""
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in columns]
    body = numbered(df, order, "n").select((F.col("n") + 2).alias("line_no"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    head = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return df.sparkSession.createDataFrame(list(enumerate(head, start=1)), "line_no long, line string").unionByName(body)


def as_json(df: DataFrame, group: str, columns: list[str], order: list[str]) -> DataFrame:
    """group, body: the group's rows as one JSON array, in order; for groups of bounded size such as an outline."""
    row = F.struct(*order, F.struct(*columns).alias("_row"))
    rows = F.transform(F.array_sort(F.collect_list(row)), lambda x: x["_row"])
    return df.groupBy(group).agg(F.to_json(rows).alias("body"))


def create_if_absent(spark: SparkSession, path: str, schema: StructType) -> bool:
    """An empty table at ``path``, unless there is one already; whether it was made."""
    try:
        spark.read.parquet(path)
        return False
    except AnalysisException:
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        return True
