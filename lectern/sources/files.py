"""Sources: JSON documents, listings, walks, line files, and the media tool's log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING = "path string, modificationTime timestamp, length long"


def json_documents(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = True) -> DataFrame:
    """Documents of a declared schema; ``whole_files``: one document per file, else one per line."""
    return spark.read.schema(schema).option("multiLine", whole_files).json(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, size_mb of the files in a folder; contents are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return f.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), megabytes(F.col("length")).alias("size_mb"))


def walk(spark: SparkSession, root: str, suffix: str, excluded: list[str], depth: int = 1) -> DataFrame:
    """path, source of the files below ``root``, at most ``depth`` folders down and in no excluded folder.

    ``source`` is the first folder below the root, or the file's own name.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root).select("path")
    base = root.rstrip("/").split("://")[-1]
    rel = F.regexp_replace("path", "^.*?" + "\\Q" + base + "\\E/", "")
    parts = F.split(rel, "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    ok = F.size(folders) <= depth
    if excluded:
        ok = ok & ~F.arrays_overlap(folders, F.array(*[F.lit(x) for x in excluded]))
    return f.filter(ok).select("path", parts[0].alias("source"))


def lines_with_letters(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines of text files that hold an ASCII letter."""
    return spark.read.text(path).select(F.trim("value").alias("line")).filter(F.col("line").rlike("[A-Za-z]"))


def megabytes(length: Column) -> Column:
    return F.round(length / 1_048_576, 1)


def probe_seconds(log: Column) -> Column:
    """Whole seconds of a ``Duration: hh:mm:ss`` in the media tool's log, 0 without one."""
    g = lambda i: F.regexp_extract(log, r"Duration: (\d+):(\d+):(\d+)", i).try_cast("int")
    return F.coalesce(g(1) * 3600 + g(2) * 60 + g(3), F.lit(0))
