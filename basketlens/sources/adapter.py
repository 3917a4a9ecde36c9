"""Retail transaction lines from TPC-H-like order tables.

A SPEND of type decimal and stable codes make every later measure exactly comparable with another
SQL engine. Every 13th order is anonymous and every 11th customer has no life stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.schema import CUSTOMER, SEGMENT


def transactions(spark: SparkSession, path: str) -> DataFrame:
    """The 22-column transaction table over lineitem, orders, customer, part and nation under ``path``."""

    def table(name):
        return spark.read.parquet(f"{path}/{name}.parquet")

    # Join sides are left to the optimizer: it broadcasts by measured size and sort-merges beyond that.
    rows = (
        table("lineitem")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    order, date = F.col("o_orderkey"), F.col("o_orderdate")
    anonymous = order % 13 == 0
    third = order % 3
    store = order % 50
    brand = F.concat_ws("|", "p_type", "p_brand")

    def known(column):
        return F.when(~anonymous, column)

    return rows.select(
        (F.year(date) * 100 + F.floor((F.dayofyear(date) - 1) / 7) + 1).cast("int").alias("SHOP_WEEK"),
        (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int").alias("SHOP_DATE"),
        (F.weekday(date) + 1).cast("int").alias("SHOP_WEEKDAY"),
        (order % 14 + 8).cast("int").alias("SHOP_HOUR"),
        F.col("l_quantity").cast("int").alias("QUANTITY"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("SPEND"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("PROD_CODE"),
        F.concat_ws("|", brand, F.col("p_size").cast("string")).alias("PROD_CODE_10"),
        F.concat_ws("|", brand, F.when(F.col("p_size") <= 25, "LO").otherwise("HI")).alias("PROD_CODE_20"),
        brand.alias("PROD_CODE_30"),
        F.col("p_type").alias("PROD_CODE_40"),
        known(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias(CUSTOMER),
        known(
            F.when(F.col("c_acctbal") < 2500, "LA").when(F.col("c_acctbal") < 6500, "MM").otherwise("UM")
        ).alias("CUST_PRICE_SENSITIVITY"),
        known(F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment"))).alias("CUST_LIFESTAGE"),
        F.concat(F.lit("B"), order.cast("string")).alias("BASKET_ID"),
        F.when(F.col("o_totalprice") < 100000, "S")
        .when(F.col("o_totalprice") < 300000, "M")
        .otherwise("L")
        .alias("BASKET_SIZE"),
        F.when(third == 0, "LA").when(third == 1, "MM").otherwise("UM").alias("BASKET_PRICE_SENSITIVITY"),
        F.col("o_orderpriority").alias("BASKET_TYPE"),
        F.col("o_orderstatus").alias("BASKET_DOMINANT_MISSION"),
        F.concat(F.lit("S"), store.cast("string")).alias("STORE_CODE"),
        F.when(store % 4 == 0, "SS")
        .when(store % 4 == 1, "MS")
        .when(store % 4 == 2, "LS")
        .otherwise("XLS")
        .alias("STORE_FORMAT"),
        F.col("n_name").alias("STORE_REGION"),
    )


def calendar(transactions_df: DataFrame) -> DataFrame:
    """Calendar lookup derived from the transactions: first and last date of every week."""
    return transactions_df.groupBy("SHOP_WEEK").agg(
        F.min("SHOP_DATE").alias("DATE_FROM"), F.max("SHOP_DATE").alias("DATE_TO")
    )


def number_segments(transactions_df: DataFrame, segments: int = 7) -> DataFrame:
    """A segment per identified customer from the customer number, for checks against SQL."""
    number = F.substring(F.col(CUSTOMER), 2, 20).cast("bigint")
    return (
        transactions_df.where(F.col(CUSTOMER).isNotNull())
        .select(CUSTOMER)
        .distinct()
        .withColumn(SEGMENT, (number % segments).cast("int"))
    )
