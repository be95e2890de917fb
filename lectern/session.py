"""Session helpers: one place that reads cluster settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "lectern", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the session that is there."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies, whatever the driver's own path is."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` where it is set.

    Only where nothing is set (tests, one machine) a new temporary folder is taken.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at


#: What this driver wrote and may delete: (session, path).
_WRITTEN: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for this driver's own intermediate data."""
    path = f"{shared_dir(spark)}/lectern-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, f"{name}.parquet")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system that Spark takes it on."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()


def shared_files(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified path, for Python tasks that read ranges of staged files."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path)
    return fs.FileSystem.from_uri(uri)


def clear_staged() -> int:
    """Delete the intermediate data that this driver wrote; results built on it must have been written or collected before."""
    done = 0
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        done += bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))
    return done
