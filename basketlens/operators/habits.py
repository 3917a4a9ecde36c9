"""Dominant shopping habits: the value of a basket attribute that a customer shows in most baskets."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.customers import by_customer, identified
from basketlens.schema import BASKET, CUSTOMER, HABIT_PREFIX, HABITS


def habit_counts(df: DataFrame, variables=HABITS) -> DataFrame:
    """(CUST_CODE, var, value, n_baskets): distinct baskets of each customer with each value, all variables in one pass.

    Lines with equal values merge on the map side, as a rule to one row per basket, and are gathered by customer once; all
    that follows keeps this layout. The rows of a basket with one row count as they are; those of other baskets become
    distinct by basket and value first.
    """
    values = [F.col(v).cast("string").alias(f"_{i}") for i, v in enumerate(variables)]
    lines = identified(df).where(F.col(BASKET).isNotNull()).select(CUSTOMER, F.col(BASKET).alias("_basket"), *values).distinct()
    several = F.count("*").over(Window.partitionBy(CUSTOMER, "_basket")) > 1
    lines = by_customer(lines).withColumn("_basket", F.when(several, F.col("_basket")))
    cells = F.inline(F.array(*[F.struct(F.lit(v).alias("var"), F.col(f"_{i}").alias("value")) for i, v in enumerate(variables)]))
    rows = lines.select(CUSTOMER, "_basket", cells).groupBy(CUSTOMER, "var", "value", "_basket").agg(F.count("*").alias("n"))
    baskets = F.sum(F.when(F.col("_basket").isNull(), F.col("n")).otherwise(1))
    return rows.groupBy(CUSTOMER, "var", "value").agg(baskets.alias("n_baskets"))


def dominant_attributes(df: DataFrame, variables=HABITS, ties: str = "all") -> DataFrame:
    """(CUST_CODE, var, value): the dominant value of each variable, NULL being a value like any other.

    A customer with equally frequent values has a row for each of them; ``ties="first"`` keeps the
    smallest one.
    """
    # One row per value is left of each customer. The profile join that follows needs this layout, and tasks that rank
    # apart from those that count hold less at a time.
    counts = habit_counts(df, variables).repartition(CUSTOMER)
    group = Window.partitionBy(CUSTOMER, "var")
    if ties == "all":
        keep = F.max("n_baskets").over(group) == F.col("n_baskets")
    elif ties == "first":
        keep = F.row_number().over(group.orderBy(F.desc("n_baskets"), F.asc_nulls_last("value"))) == 1
    else:
        raise ValueError("ties must be 'all' or 'first'")
    return counts.withColumn("_keep", keep).where("_keep").select(CUSTOMER, "var", "value")


def dominant_attribute(df: DataFrame, variable: str, ties: str = "all") -> DataFrame:
    """(CUST_CODE, DOM_CUST_<variable>) for one variable."""
    rows = dominant_attributes(df, [variable], ties)
    typed = F.col("value").cast(df.schema[variable].dataType)
    return rows.select(CUSTOMER, typed.alias(HABIT_PREFIX + variable))


def customer_attributes(df: DataFrame, variables=HABITS) -> DataFrame:
    """One row per customer, one array column DOM_CUST_<variable> per habit with all tied values, sorted.

    Tied values stay inside their row instead of multiplying the rows of the customer.
    """
    rows = dominant_attributes(df, variables)
    columns = [
        F.sort_array(F.collect_list(F.when(F.col("var") == v, F.col("value")))).alias(HABIT_PREFIX + v)
        for v in variables
    ]
    return rows.groupBy(CUSTOMER).agg(*columns)
