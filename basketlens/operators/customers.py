"""Customers: who is identified, who is sampled, and their dense index."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions import HASH_RANGE, hash32, hash_bucket
from basketlens.schema import CUSTOMER


def identified(df: DataFrame, keep_anonymous: bool = False) -> DataFrame:
    """Lines of known shoppers; anonymous lines would otherwise form one giant customer."""
    return df if keep_anonymous else df.where(F.col(CUSTOMER).isNotNull())


def by_customer(df: DataFrame) -> DataFrame:
    """``df`` laid out by customer for rows that grow in number afterwards: in twice the usual number of partitions, which
    are not merged by the size they have before, so that a task holds little at a time."""
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), CUSTOMER)


def sample_customers(df: DataFrame, rate: float, seed: int = 42, key: str = CUSTOMER) -> DataFrame:
    """All lines of a share ``rate`` of the customers; anonymous lines are left out.

    A customer is in or out by a hash of the seed and the code, so there is no distinct, no join and
    no dependence on the layout, and two tables sampled with one seed hold the same customers.
    """
    return df.where(in_sample(rate, seed, key))


def in_sample(rate: float, seed: int = 42, key: str = CUSTOMER) -> Column:
    """Whether a customer is in the sample; NULL for anonymous lines."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    return hash32(seed, F.col(key)) < int(rate * HASH_RANGE)


def customer_index(df: DataFrame, hex_digits: int = 3, keep_anonymous: bool = False) -> DataFrame:
    """(CUST_CODE, cust_idx): distinct customers numbered 0..n-1, the anonymous one first if it is kept.

    The order is (hash bucket, code). Bucket starts are a running sum over 16 ** hex_digits counts,
    few enough to broadcast, and each bucket ranks its own customers, so no task sees all of them.
    """
    if not 1 <= hex_digits <= 5:
        raise ValueError("hex_digits must lie between 1 and 5")
    customers = (
        identified(df, keep_anonymous)
        .select(CUSTOMER)
        .distinct()
        .withColumn("bucket", F.coalesce(hash_bucket(F.col(CUSTOMER), hex_digits), F.lit("")))
    )
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        customers.groupBy("bucket")
        .agg(F.count("*").alias("size"))
        .select("bucket", F.coalesce(F.sum("size").over(running), F.lit(0)).alias("start"))
    )
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(CUSTOMER))
    return (
        customers.withColumn("rank", rank)
        .join(F.broadcast(starts), "bucket", "left")
        .select(CUSTOMER, (F.col("start") + F.col("rank") - 1).cast("bigint").alias("cust_idx"))
    )


def to_index(df: DataFrame, index: DataFrame) -> DataFrame:
    """Replace CUST_CODE by cust_idx, also that of the anonymous customer where it is kept."""
    index = index.withColumnRenamed(CUSTOMER, "_code")
    return df.join(index, F.col(CUSTOMER).eqNullSafe(F.col("_code"))).drop(CUSTOMER, "_code")


def to_code(df: DataFrame, index: DataFrame) -> DataFrame:
    """Replace cust_idx by CUST_CODE: vectors find their customer by key, never by position."""
    return df.join(index, "cust_idx").drop("cust_idx")
