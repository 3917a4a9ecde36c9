"""Raw files in, staged tables out."""

import fnmatch
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.schema import CALENDAR, TRANSACTIONS
from basketlens.sources import storage


def read_transactions(spark: SparkSession, path: str, glob: str = "*transactions*") -> DataFrame:
    """All transaction CSV files under ``path`` whose path below it, folders included, matches ``glob``, as one scan.

    The header line is skipped and columns bind by position; a cell that does not parse becomes NULL.
    No matching file gives an empty table of the same schema.
    """
    files = _read_csv(spark, path, TRANSACTIONS, {"header": True, "recursiveFileLookup": True})
    if not files.inputFiles():
        return files
    # The reader's own name filter sees file names only and would lose the files of a folder "transactions".
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath().rstrip("/")
    wanted = fnmatch.translate(glob).replace("\\z", "$").replace("\\Z", "$")
    if all(re.search(wanted, name.split(root, 1)[-1]) for name in files.inputFiles()):
        return files  # nothing to leave out, so no line is asked for its file
    below = F.element_at(F.split(F.col("_metadata.file_path"), "\\Q" + root + "\\E", 2), -1)
    return files.where(below.rlike(wanted))


def write_raw(df: DataFrame, path: str, key: str) -> None:
    """``df`` as compressed CSV files with a header, in passes over ranges of the hash of ``key`` where it reads much."""
    n = storage.passes(df)
    with storage.shuffles_freed(df.sparkSession):
        for i in range(n):
            part = df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) if n > 1 else df
            # A compressed file is read by one task, so it has so many lines at most.
            options = {"header": True, "compression": "gzip", "maxRecordsPerFile": 1_000_000}
            part.write.options(**options).mode("append" if i else "overwrite").csv(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The calendar lookup in ``<path>/time.csv``, empty if there is none."""
    return _read_csv(spark, f"{path.rstrip('/')}/time.csv", CALENDAR, {"header": True})


def _read_csv(spark: SparkSession, path: str, schema: StructType, options: dict) -> DataFrame:
    try:
        return spark.read.schema(schema).options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def union_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by position, for tables that can not be read in one scan."""
    for other in others:
        first = first.union(other)
    return first


def write_staged(df: DataFrame, path: str, partition_by: str | None = "SHOP_WEEK", by_file: bool = False) -> None:
    """Overwrite ``path`` with parquet, one folder per week; ``None`` writes a small lookup as it is.

    The rebalance hint shuffles by week but splits a week that is too large for one task and merges
    weeks that are small, so neither a dominant week nor a long tail of weeks hurts.

    ``by_file`` is for rows that come straight from a scan of files: many of them are taken in passes, each over files of its
    own, so that the disks hold the shuffle of one pass and not that of all rows.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    n = storage.passes(df) if by_file else 1
    with storage.shuffles_freed(df.sparkSession):
        for i in range(n):
            part = df.where(F.pmod(F.xxhash64("_metadata.file_path"), F.lit(n)) == i) if n > 1 else df
            part = part.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by)
            part.mode("append" if i else "overwrite").parquet(path)


def read_staged(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A staged table; with ``schema`` the columns come back in that order, and no file is opened to infer it."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
