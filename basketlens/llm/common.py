"""Shared helpers of the operators: the shared folder, files in it, word columns."""

import atexit
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# Words are maximal runs of anything but the six ASCII white-space characters.
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are shared by the driver and all executors. The folder is deleted when the driver ends,
    or earlier by ``discard``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _FOLDERS:
        atexit.register(lambda: [discard(spark, p) for p in list(_FOLDERS)])
    _FOLDERS.append(path)
    return path


_FOLDERS: list[str] = []


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder``; nothing happens if the session has ended."""
    if path in _FOLDERS:
        _FOLDERS.remove(path)
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def save(df: DataFrame, name: str) -> str:
    """Write ``df`` to the shared folder and return the path; a reader starts from there, not from the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Continue from a written copy of ``df``: lost executors then cost no earlier step."""
    path = save(df, name)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Delete what ``cut`` wrote, once nothing reads it any more."""
    for df in cuts:
        discard(df.sparkSession, df.cut_path)


def bucketed(docs: DataFrame, name: str) -> DataFrame:
    """The documents as a table bucketed by ``doc``: later joins on it move no text.

    ``doc`` is the doc_id. Rows without one take a number from 2**62 on, a hash of their text, which spreads them and keeps
    what is gathered per ``doc`` as small as one text. ``row`` holds the columns; ``copy`` tells texts apart that share a doc_id, and ``lead`` marks one row of each. The table goes when the driver ends."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{name}_{uuid.uuid4().hex}"
    nameless = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), nameless).alias("doc"))
    by_text = Window.partitionBy("doc").orderBy("row.text")
    keyed = keyed.repartition(n, "doc").withColumns({"copy": F.dense_rank().over(by_text) - 1, "lead": F.row_number().over(by_text) == F.rank().over(by_text)})
    keyed.write.bucketBy(n, "doc").sortBy("doc").option("compression", "zstd").saveAsTable(name)
    atexit.register(lambda: spark.sparkContext._jsc and spark.sql(f"drop table if exists {name}"))
    return spark.table(name)


def _bare(uri: str) -> str:
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def store(uri: str):
    """(file system, path) of a URI of the shared folder, for file formats that Spark has no writer for."""
    return pafs.FileSystem.from_uri("file://" + _bare(uri) if uri.startswith("file:") else uri)


def publish(uri: str, name: str, data: bytes) -> str:
    """Write a file under ``uri`` so that a repeated task attempt can't leave half of it; return its URI."""
    fs, path = store(uri)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(data)
    try:
        fs.move(part, f"{path}/{name}")
    except OSError:  # some file systems don't replace the file of an earlier attempt
        if fs.get_file_info(f"{path}/{name}").type == pafs.FileType.NotFound:
            raise
        fs.delete_file(part)
    return f"{uri}/{name}"


def extended(df: DataFrame, **kinds: str) -> StructType:
    """The schema of ``df`` with more columns at its end."""
    more = StructType([StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items()])
    return StructType([*df.schema.fields, *more.fields])


def sorted_runs(batches, keys: int):
    """Tables of the rows that share the first ``keys`` columns (whole numbers), from batches sorted by them."""
    held = []

    def ends(t):
        change = np.zeros(max(0, t.num_rows - 1), bool)
        for i in range(keys):
            values = t.column(i).to_numpy()
            change |= values[1:] != values[:-1]
        return np.flatnonzero(change) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held).combine_chunks()
        at = ends(t)
        if len(at):
            for a, b in zip([0, *at[:-1]], at):
                yield t.slice(a, b - a)
            held = t.slice(at[-1]).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. No array is built; the possessive form gives nothing back, which makes it cheaper."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE + "+")).cast("long")
