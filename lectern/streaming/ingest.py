"""Incremental ingest with Structured Streaming: what is there is taken once, then the query ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import scratch


def read_new(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """A file stream over the parquet files that ``path`` (a folder or a pattern) names."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", each=None):
    """Take all that is new since ``checkpoint``; with ``each``, batches go to that function, else to parquet at ``sink``."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(mode)
    q = w.foreachBatch(each).start() if each else w.format("parquet").option("path", sink).start()
    q.awaitTermination()
    return q


def ingest(spark: SparkSession, source: str, schema, columns: list[str], home: str | None = None) -> DataFrame:
    """Rows of the source's files, each exactly once, however often it runs with the same ``home``."""
    home = home or scratch(spark, "stream")
    run_available(read_new(spark, source, schema).select(*columns), f"{home}/rows", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/rows")


def progress(spark: SparkSession, source: str, schema, status: str, value: str, home: str | None = None) -> DataFrame:
    """status, n, total: running counts by status, kept as stream state; every batch overwrites the table (idempotent)."""
    home = home or scratch(spark, "stream")
    agg = read_new(spark, source, schema).groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))

    def put(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{home}/progress")

    run_available(agg, "", f"{home}/checkpoint", "complete", put)
    return spark.read.parquet(f"{home}/progress")
