"""Stable hashes that any SQL engine can recompute, so that sampling does not depend on the layout."""

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash32(*parts) -> Column:
    """Unsigned 32-bit number from the md5 of the parts joined by ':' (NULL if the last part is NULL)."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat(*[c for pair in zip(columns, [F.lit(":")] * len(columns)) for c in pair][:-1])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(column: Column, hex_digits: int = 3) -> Column:
    """First hex digits of the md5: 16 ** hex_digits buckets of even size over distinct keys."""
    return F.substring(F.md5(column), 1, hex_digits)
