"""Shared-folder tables: cut points of long jobs, artifacts and reports."""

import atexit
import math
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A write in passes has one for so many bytes of files that it reads, and so many at most: each leaves files of its own.
PASS_BYTES, PASSES = 256 << 20, 8


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder given by ``spark.checkpoint.dir``.

    Where the session does not name one, the warehouse is used, which all executors share as well. No setting is
    changed. The folder is deleted when the driver ends.
    """
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_discard, spark, path)
    return path


def _discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, unless the session has ended."""
    context = spark.sparkContext
    if context._jsc is not None:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def passes(df: DataFrame) -> int:
    """In how many passes to write what ``df`` reads from files, where the shuffle of all of it would fill the disks."""
    context = df.sparkSession.sparkContext
    paths = [context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(name)) for name in df.inputFiles()]
    held = sum(p.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)
    return max(1, min(PASSES, math.ceil(held / PASS_BYTES)))


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, a write deletes its shuffle files when it ends; otherwise they stay until the driver's collector comes by."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with parquet (vocabulary, customer index, documents, vectors, segment scores)."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path)


def write_report(df: DataFrame, path: str, order_by=()) -> None:
    """Overwrite ``path`` with CSV files that have a header, sorted if asked; rows never visit the driver."""
    if order_by:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
