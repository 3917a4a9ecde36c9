"""Customer documents: the distinct products of a customer as a sequence of vocabulary indexes."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.vocabulary import UNKNOWN, indexed_products
from basketlens.schema import CUSTOMER, PRODUCT


def customer_documents(
    df: DataFrame, vocab: DataFrame, num_prods: int, keep_anonymous: bool = False, order_by: str | None = None
) -> DataFrame:
    """(CUST_CODE, n_unknown, prod_idxs): one document per customer, in index order.

    A document is ``n_unknown`` times index 0 followed by the ascending indexes in ``prod_idxs``.
    Kept in these two parts, the array of any customer is shorter than the vocabulary however many
    products or lines the customer has.

    ``order_by`` orders the products by their first value of that column, for example the date of the first purchase, and
    then by code. ``prod_idxs`` has the known ones in that order, and a further column ``unknown_runs`` the places (at),
    lengths (n) and known products before (before) of the runs of unknown ones: fewer than there are known ones, plus one.
    """
    if order_by:
        return _ordered(indexed_products(df, vocab, num_prods, keep_anonymous, order_by))
    # Unknown products are counted before lists are gathered, in buffers of a number; those of lists are objects.
    counts = indexed_products(df, vocab, num_prods, keep_anonymous).groupBy(CUSTOMER, "prod_idx").agg(F.count("*").cast("int").alias("n"))
    unknown = F.sum(F.when(F.col("prod_idx") == UNKNOWN, F.col("n")))
    known = F.when(F.col("prod_idx") != UNKNOWN, F.array_repeat("prod_idx", F.col("n")))
    return counts.groupBy(CUSTOMER).agg(
        F.coalesce(unknown, F.lit(0)).cast("int").alias("n_unknown"),
        F.sort_array(F.flatten(F.collect_list(known))).alias("prod_idxs"),
    )


def _ordered(products: DataFrame) -> DataFrame:
    """Documents of (CUST_CODE, PROD_CODE, prod_idx, first) rows. A customer's rows, one per product, are sorted in one
    task, which spills; runs are counted there, so that what is gathered is bounded by the vocabulary."""
    group = Window.partitionBy(CUSTOMER).orderBy(F.col(PRODUCT).isNull(), F.asc_nulls_last("first"), PRODUCT)
    known = F.col("prod_idx") != UNKNOWN
    rows = products.withColumns(
        {
            "at": F.row_number().over(group) - 1,
            "before": F.sum(known.cast("int")).over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"),
            "known": known,
        }
    )
    runs = rows.groupBy(CUSTOMER, "known", "before").agg(
        F.min("at").alias("at"), F.count("*").cast("int").alias("n"), F.max("prod_idx").alias("prod_idx")
    )
    found = F.sort_array(F.collect_list(F.when(F.col("known"), F.struct("at", "prod_idx")))).getField("prod_idx")
    gaps = F.sort_array(F.collect_list(F.when(~F.col("known"), F.struct("at", "n", F.coalesce("before", F.lit(0)).alias("before")))))
    unknown = F.coalesce(F.sum(F.when(~F.col("known"), F.col("n"))), F.lit(0)).cast("int")
    return runs.groupBy(CUSTOMER).agg(unknown.alias("n_unknown"), found.alias("prod_idxs"), gaps.alias("unknown_runs"))


def length() -> Column:
    """Number of products of a document."""
    return F.col("n_unknown") + F.size("prod_idxs")


def item(position: Column) -> Column:
    """Product index at a position counted from 0."""
    known = F.get(F.col("prod_idxs"), position - F.col("n_unknown"))
    return F.when(position < F.col("n_unknown"), F.lit(UNKNOWN)).otherwise(known)


def sequence(ordered: bool = False) -> Column:
    """The whole document as one array; ``ordered`` for documents with ``unknown_runs``."""
    if not ordered:
        return F.concat(F.array_repeat(F.lit(UNKNOWN), F.col("n_unknown")), F.col("prod_idxs"))
    runs = F.col("unknown_runs")

    def part(run, i):
        done = F.when(i > 0, F.get(runs, i - 1).getField("before")).otherwise(0)
        return F.concat(F.slice("prod_idxs", done + 1, run.before - done), F.array_repeat(F.lit(UNKNOWN), run.n))

    last = F.coalesce(F.try_element_at(runs, F.lit(-1)).getField("before"), F.lit(0))
    return F.concat(F.flatten(F.transform(runs, part)), F.slice("prod_idxs", last + 1, F.size("prod_idxs")))
