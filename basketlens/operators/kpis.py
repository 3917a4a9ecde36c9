"""Segment membership and segment KPIs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions import exact_sum, money_units, to_money
from basketlens.operators.customers import identified
from basketlens.schema import BASKET, CUSTOMER, SEGMENT


def one_segment_each(scored: DataFrame, seg: str = SEGMENT) -> DataFrame:
    """``scored`` with one row per customer; a customer in two segments is an error, not a silent fan-out.

    The grouping shuffles by customer, which is the partitioning that the following joins need.
    """
    low, high = F.min(seg), F.max(seg)
    conflict = F.raise_error(F.concat(F.lit("customer in two segments: "), F.col(CUSTOMER)))
    return (
        scored.where(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER)
        .agg(low.alias(seg), high.alias("_high"))
        .select(CUSTOMER, F.when(F.col(seg).eqNullSafe(F.col("_high")), F.col(seg)).otherwise(conflict).alias(seg))
    )


def segment_kpis(trans: DataFrame, scored: DataFrame, seg: str = SEGMENT, approx: bool = False) -> DataFrame:
    """Sales, units, baskets and customers of each segment and their ratios; a zero divisor gives NULL.

    Lines are summed to one row per customer and basket before the join, so a customer or basket
    with very many lines is reduced on the map side and the join moves baskets, not lines. Both
    sides of the join come straight from a shuffle, the form in which the runtime can split the
    partition of a customer who holds a large share of all baskets. Baskets are counted from one row
    per segment and basket, customers from one row per segment and customer, so no row is multiplied
    to count two things at once. A customer who is scored into several segments counts in each.
    """
    baskets = (
        identified(trans)
        .groupBy(CUSTOMER, BASKET)
        .agg(F.sum(money_units("SPEND")).alias("spend"), F.sum("QUANTITY").alias("units"))
    )
    scored = scored.select(CUSTOMER, seg)
    joined = baskets.join(scored, CUSTOMER)
    if approx:
        totals = joined.groupBy(seg).agg(
            to_money(exact_sum("spend")).alias("TOT_SALES"),
            F.sum("units").alias("TOT_UNITS"),
            F.approx_count_distinct(BASKET).alias("TOT_BASKS"),
            F.approx_count_distinct(CUSTOMER).alias("TOT_CUSTS"),
        )
    else:
        sales = (
            joined.groupBy(seg, BASKET)
            .agg(exact_sum("spend").alias("spend"), F.sum("units").alias("units"))
            .groupBy(seg)
            .agg(
                to_money(F.sum("spend")).alias("TOT_SALES"),
                F.sum("units").alias("TOT_UNITS"),
                F.count(BASKET).alias("TOT_BASKS"),
            )
        )
        shoppers = identified(trans).select(CUSTOMER).distinct().join(scored.distinct(), CUSTOMER)
        customers = shoppers.groupBy(seg).agg(F.count("*").alias("TOT_CUSTS"))
        # A row per segment of each; the maximum keeps the one that is there.
        totals = (
            sales.unionByName(customers, allowMissingColumns=True)
            .groupBy(seg)
            .agg(*[F.max(c).alias(c) for c in ("TOT_SALES", "TOT_UNITS", "TOT_BASKS", "TOT_CUSTS")])
        )
    ratios = {
        "SPEND_PER_BASK": ("TOT_SALES", "TOT_BASKS"),
        "UNITS_PER_BASK": ("TOT_UNITS", "TOT_BASKS"),
        "SPEND_PER_CUST": ("TOT_SALES", "TOT_CUSTS"),
        "UNITS_PER_CUST": ("TOT_UNITS", "TOT_CUSTS"),
        "PPU": ("TOT_SALES", "TOT_UNITS"),
    }
    return totals.withColumns({name: F.try_divide(F.col(a), F.col(b)) for name, (a, b) in ratios.items()})
