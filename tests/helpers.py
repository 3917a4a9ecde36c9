"""Small transaction tables made by hand."""

import time

from pyspark.sql import functions as F

from basketlens.schema import TRANSACTIONS


def lines(spark, rows, **defaults):
    """Transactions from dicts; a column that no row names is NULL."""
    base = {f.name: None for f in TRANSACTIONS.fields}
    return spark.createDataFrame([tuple({**base, **defaults, **r}.values()) for r in rows], TRANSACTIONS)


def purchases(spark, baskets):
    """Lines (CUST_CODE, BASKET_ID, PROD_CODE) from tuples."""
    return lines(spark, [{"CUST_CODE": c, "BASKET_ID": b, "PROD_CODE": p} for c, b, p in baskets])


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def scattered(df, parts=5):
    """The same rows in another layout."""
    return df.repartition(parts, F.rand(7))


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that were not there before; they are deleted beside the job, within a moment."""
    for _ in range(20):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.2)
    return found
