"""Wide to long."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_rows(df: DataFrame, keys, variables: Mapping[str, Column]) -> DataFrame:
    """One row (keys..., var, value) per key row and variable, value as string.

    ``inline`` is used instead of ``unpivot`` because a generator keeps the partitioning of its
    input, which lets the next grouping on the keys run without another shuffle.
    """
    cells = [
        F.struct(F.lit(name).alias("var"), column.cast("string").alias("value"))
        for name, column in variables.items()
    ]
    table = F.array(*cells) if cells else F.array().cast("array<struct<var:string,value:string>>")
    return df.select(*keys, F.inline(table))
