"""Index profiles: how much more often a segment shows a value than the whole customer base does."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions import long_rows
from basketlens.operators.customers import by_customer, identified
from basketlens.operators.habits import dominant_attributes
from basketlens.operators.kpis import one_segment_each
from basketlens.schema import BASKET, CUSTOMER, HABIT_PREFIX, REPORT_VARIABLES, SEGMENT


def segment_sizes(members: DataFrame, seg: str = SEGMENT) -> DataFrame:
    """(seg, TOT_CUSTS_SEG): distinct customers of each segment."""
    return members.groupBy(seg).agg(F.countDistinct(CUSTOMER).alias("TOT_CUSTS_SEG"))


def customer_total(members: DataFrame) -> DataFrame:
    """One row (TOT_CUSTS): distinct customers over all segments."""
    return members.agg(F.countDistinct(CUSTOMER).alias("TOT_CUSTS"))


def _index_profile(counts: DataFrame, members: DataFrame, seg: str) -> DataFrame:
    """Shares and indexes from (seg, var, value, n) counts and one (customer, seg) row per customer.

    Everything after ``counts`` has a row per segment and value at most. The segment sizes are a
    few rows that the runtime broadcasts once their size is known.
    """
    sizes = members.groupBy(seg).agg(F.count("*").alias("size"))
    total = F.sum("size").over(Window.partitionBy())
    sizes = sizes.select(F.col(seg), "size", total.alias("total"))
    overall = F.sum("n").over(Window.partitionBy("var", "value"))
    return (
        counts.where(F.col("value").isNotNull())
        .withColumn("overall", overall)
        .join(sizes, seg)
        .withColumn("PERC_SEG", F.col("n") / F.col("size"))
        .select(
            F.col("value").alias("var_detail"),
            F.col(seg),
            "PERC_SEG",
            (F.col("PERC_SEG") / (F.col("overall") / F.col("total")) * 100).alias("INDEX"),
            "var",
        )
    )


def segment_profile(df: DataFrame, variable: str, seg: str = SEGMENT) -> DataFrame:
    """Index profile of one variable of any table with a customer, a segment and the variable.

    PERC_SEG is the share of the segment's customers that show the value, INDEX is 100 times its
    ratio to the share over all customers. Customers with several values count under each.
    """
    members = one_segment_each(identified(df).select(CUSTOMER, seg), seg)
    counts = (
        identified(df)
        .select(CUSTOMER, seg, F.lit(variable).alias("var"), F.col(variable).cast("string").alias("value"))
        .distinct()
        .groupBy(seg, "var", "value")
        .agg(F.count("*").alias("n"))
    )
    return _index_profile(counts, members, seg)


def profile_members(trans: DataFrame, scored: DataFrame, seg: str = SEGMENT) -> DataFrame:
    """(CUST_CODE, seg) of the scored customers that have a basket: the base of all shares."""
    shoppers = identified(trans).where(F.col(BASKET).isNotNull()).select(CUSTOMER).distinct()
    return shoppers.join(one_segment_each(scored, seg), CUSTOMER)


def segment_profiles(
    trans: DataFrame,
    scored: DataFrame,
    variables=REPORT_VARIABLES,
    seg: str = SEGMENT,
    ties: str = "all",
) -> DataFrame:
    """Index profiles of many variables at once: (var_detail, seg, PERC_SEG, INDEX, var).

    Variables named DOM_CUST_<column> are dominant habits, all others are read from the lines. Both
    kinds become (customer, var, value) rows once, are joined to the segments on the customer and
    counted together, so the number of passes over the lines does not grow with the variables.
    """
    habits = [v.removeprefix(HABIT_PREFIX) for v in variables if v.startswith(HABIT_PREFIX)]
    traits = [v for v in variables if not v.startswith(HABIT_PREFIX)]
    members = profile_members(trans, scored, seg)
    parts = []
    if habits:
        rows = dominant_attributes(trans, habits, ties)
        rows = rows.withColumn("var", F.concat(F.lit(HABIT_PREFIX), "var"))
        parts.append(rows.join(members, CUSTOMER))
    if traits:
        # Lines merge on the map side before every trait makes a row of its own. They are gathered by customer before
        # that, so that neither the distinct values nor the join with the members moves the longer rows.
        lines = by_customer(identified(trans).select(CUSTOMER, *traits).distinct())
        rows = long_rows(lines, [CUSTOMER], {v: F.col(v) for v in traits}).distinct()
        parts.append(rows.join(members, CUSTOMER))
    if not parts:
        raise ValueError("no variables to profile")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    counts = rows.groupBy(seg, "var", "value").agg(F.count("*").alias("n"))
    return _index_profile(counts, members, seg)
