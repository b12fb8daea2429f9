"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or below a folder of our own where that is unset and one machine does all the work."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = getattr(spark, "_quillon_tables", None)
        if base is None:
            base = spark._quillon_tables = "file://" + tempfile.mkdtemp(prefix="quillon-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def settled(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once into the shared folder, for what reads them several times."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def contents(rows: DataFrame) -> str:
    """A digest of the names, sizes and times of the files that rows are read from."""
    spark, digest = rows.sparkSession, hashlib.sha256()
    for name in sorted(rows.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        digest.update(f"{name}|{status.getLen()}|{status.getModificationTime()};".encode())
    return digest.hexdigest()


def kept(source: DataFrame, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is built once a session from a source, and again when the source's files have changed: an index."""
    spark = source.sparkSession
    tables = getattr(spark, "_quillon_kept", None)
    if tables is None:
        tables = spark._quillon_kept = {}
    now = contents(source)
    if tables.get(key, ("",))[0] != now:
        tables[key] = (now, settled(build(), "kept"))
    return tables[key][1]
