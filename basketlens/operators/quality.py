"""Data quality reports. Each one is a single aggregation over all columns, returned as a table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from basketlens.functions import long_rows
from basketlens.sources.storage import materialize


# Parts of a column whose values are ranked apart.
SALTS = 64

# Columns whose distinct values are counted, and the size of their sketches (two to this power).
SUMMARY = ("BASKET_ID", "PROD_CODE", "SHOP_WEEK")
SKETCH_LG = 14

# So many digests of 16 bytes are broadcast; more are joined by a shuffle.
BROADCAST_DIGESTS = 1 << 20


def head(df: DataFrame, n: int = 10, order_by=()) -> DataFrame:
    """The first ``n`` rows, in the given order if there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable) of the table."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields, "position int, column string, type string, nullable boolean")


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def dataset_summary(df: DataFrame, columns=SUMMARY, approx: bool = False) -> DataFrame:
    """One row n_<column>: distinct values of each column, NULL being one value.

    Values of all columns are made distinct in one pass, on the map side first, and each is counted once;
    ``approx`` estimates the numbers from sketches, which moves a few kilobytes per column and task.
    """
    if approx:
        return merged_summary(value_sketches(df, columns), columns)
    values = long_rows(df, [], {c: F.col(c) for c in columns}).distinct()
    return values.agg(*[F.count_if(F.col("var") == c).alias(f"n_{c.lower()}") for c in columns])


def value_sketches(df: DataFrame, columns=SUMMARY, by=("SHOP_WEEK",)) -> DataFrame:
    """One row per ``by`` group, for example per week: a mergeable sketch of each column's values, and whether NULL is among them.

    New weeks are sketched alone and merged with those that are there; old lines are not read again."""
    parts = [(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_LG)).alias(f"sketch_{c.lower()}"), F.max(F.col(c).isNull()).alias(f"null_{c.lower()}")) for c in columns]
    return df.groupBy(*[F.col(c).alias(f"by_{c.lower()}") for c in by]).agg(*[c for pair in parts for c in pair])


def merged_summary(sketches: DataFrame, columns=SUMMARY) -> DataFrame:
    """The estimates of ``dataset_summary`` from any union of ``value_sketches``."""

    def estimate(c):
        found = F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}"))
        return (F.coalesce(found, F.lit(0)) + F.coalesce(F.max(f"null_{c}").cast("bigint"), F.lit(0))).alias(f"n_{c}")

    return sketches.agg(*[estimate(c.lower()) for c in columns])


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of the whole row. NULLs are hashed by their places, which the hash function would skip."""
    gaps = F.array(*[F.col(c).isNull() for c in df.columns])
    return [F.xxhash64(F.lit(i), gaps, *df.columns).alias(f"_digest{i}") for i in (0, 1)]


def duplicate_check(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_distinct_rows).

    Rows meet as digests of 16 bytes, added up on the map side. A digest that is met once is a distinct row. Where it is met
    more often, the rows themselves are compared; equal rows are merged on the map side before that shuffle.
    """
    spark, rows = df.sparkSession, df.select(*df.columns, *row_digest(df))
    keys = ["_digest0", "_digest1"]
    counts = materialize(rows.groupBy(*keys).agg(F.count("*").alias("copies")), "digests")
    n_rows, single, several = counts.agg(F.sum("copies"), F.count_if(F.col("copies") == 1), F.count_if(F.col("copies") > 1)).first()
    distinct = single
    if several:
        met = counts.where("copies > 1").select(*keys)
        met = F.broadcast(met) if several <= BROADCAST_DIGESTS else met
        distinct += rows.join(met, keys).select(*df.columns).distinct().count()
    return spark.createDataFrame([(n_rows or 0, distinct)], "n_rows bigint, n_distinct_rows bigint")


def _missing(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _one_row_to_long(row: DataFrame, names, measures) -> DataFrame:
    """A single wide row with columns <measure>_<name> as one row (column, measures...) per name."""
    entries = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{m}_{n}").alias(m) for m in measures]) for n in names
    ]
    return row.select(F.inline(F.array(*entries)))


def missing_rates(df: DataFrame) -> DataFrame:
    """(column, missing_rate): share of NULL, or NaN where the type has one."""
    names = df.columns
    rates = [F.avg(_missing(df, c).cast("double")).alias(f"missing_rate_{c}") for c in names]
    return _one_row_to_long(df.agg(*rates), names, ["missing_rate"])


def numeric_profile(df: DataFrame) -> DataFrame:
    """(column, mean, max, min, std) of every numeric column, std being the sample deviation."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    measures = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}
    if not names:
        schema = ", ".join(["column string", *[f"{m} double" for m in measures]])
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(
        *[fn(F.col(c).cast("double")).alias(f"{m}_{c}") for c in names for m, fn in measures.items()]
    )
    return _one_row_to_long(row, names, list(measures))


def top_values(df: DataFrame, n: int = 20) -> DataFrame:
    """(column, value, n_rows, position): the ``n`` most frequent values of every string column.

    NULL is a value; equal counts are ordered by value, NULL last. Values are ranked in ``SALTS`` parts of
    their column first, and only ``n`` of each part are ranked together, so a column of nearly unique
    codes does not travel to one task, whatever ``n`` and the session's settings are.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    counts = (
        long_rows(df, [], {c: F.col(c) for c in names})
        .groupBy(F.col("var").alias("column"), "value")
        .agg(F.count("*").alias("n_rows"))
    )
    order = [F.desc("n_rows"), F.asc_nulls_last("value")]
    part = Window.partitionBy("column", F.pmod(F.hash("value"), F.lit(SALTS))).orderBy(*order)
    counts = counts.withColumn("position", F.row_number().over(part)).where(F.col("position") <= n)
    rank = Window.partitionBy("column").orderBy(*order)
    return counts.withColumn("position", F.row_number().over(rank)).where(F.col("position") <= n)


def all_reports(df: DataFrame, n_head: int = 10, n_top: int = 20) -> dict[str, DataFrame]:
    """Every report of a table, by name; nothing runs until one is used."""
    return {
        "head": head(df, n_head),
        "schema": schema_report(df),
        "shape": shape(df),
        "duplicates": duplicate_check(df),
        "missing": missing_rates(df),
        "top_values": top_values(df, n_top),
        "numeric": numeric_profile(df),
    }
