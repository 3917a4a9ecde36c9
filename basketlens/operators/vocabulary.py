"""Product vocabulary: the most frequent products get an index, all others share index 0."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.customers import identified
from basketlens.schema import CUSTOMER, PRODUCT

UNKNOWN = 0


def product_counts(df: DataFrame, keep_anonymous: bool = False) -> DataFrame:
    """(PROD_CODE, n_rows): transaction lines of each product."""
    return (
        identified(df, keep_anonymous)
        .where(F.col(PRODUCT).isNotNull())
        .groupBy(PRODUCT)
        .agg(F.count("*").alias("n_rows"))
    )


def vocabulary(df: DataFrame, num_prods: int, keep_anonymous: bool = False) -> DataFrame:
    """(PROD_CODE, prod_idx, n_rows): the ``num_prods - 1`` products with most lines, numbered from 1.

    Equal counts are ordered by code. Index 0 is reserved by number, so a product whose code happens
    to be a placeholder word is a product like any other. The top rows are found task by task; only
    the rows that remain, at most ``num_prods - 1``, are ranked together.
    """
    if num_prods < 1:
        raise ValueError("num_prods counts the unknown product and must be at least 1")
    order = [F.desc("n_rows"), F.asc(PRODUCT)]
    top = product_counts(df, keep_anonymous).orderBy(*order).limit(num_prods - 1)
    rank = F.row_number().over(Window.orderBy(*order)).cast("int")
    return top.select(PRODUCT, rank.alias("prod_idx"), "n_rows")


def indexed_products(
    df: DataFrame, vocab: DataFrame, num_prods: int, keep_anonymous: bool = False, first_of: str | None = None
) -> DataFrame:
    """Distinct (CUST_CODE, PROD_CODE, prod_idx) rows; a product outside the vocabulary has index 0.

    ``first_of`` adds ``first``, the smallest value of that column over the customer's lines of the product.

    Repeated purchases are merged on the map side before anything is shuffled or joined. The size of
    the vocabulary, as the optimizer measures it, decides whether it is broadcast.
    """
    first = [F.min(first_of).alias("first")] if first_of else []
    pairs = identified(df, keep_anonymous).groupBy(CUSTOMER, PRODUCT).agg(*first) if first else identified(df, keep_anonymous).select(CUSTOMER, PRODUCT).distinct()
    lookup = vocab.select(PRODUCT, "prod_idx")
    known = F.coalesce("prod_idx", F.lit(UNKNOWN))
    index = F.when(F.col(PRODUCT).isNotNull(), known)
    return pairs.join(lookup, PRODUCT, "left").select(CUSTOMER, PRODUCT, index.alias("prod_idx"), *(["first"] if first_of else []))


def oov_summary(df: DataFrame, vocab: DataFrame, num_prods: int, keep_anonymous: bool = False) -> DataFrame:
    """One row (n_pairs, n_unknown): distinct customer and product pairs, and those outside the vocabulary."""
    pairs = indexed_products(df, vocab, num_prods, keep_anonymous).where(F.col("prod_idx").isNotNull())
    return pairs.agg(
        F.count("*").alias("n_pairs"), F.count(F.when(F.col("prod_idx") == UNKNOWN, 1)).alias("n_unknown")
    )
