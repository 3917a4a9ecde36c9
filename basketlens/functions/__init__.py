"""Column expressions shared by the operators. All of them run inside the JVM."""

from basketlens.functions.hashing import HASH_RANGE, hash32, hash_bucket
from basketlens.functions.money import exact_sum, money_units, to_money
from basketlens.functions.reshape import long_rows

__all__ = ["HASH_RANGE", "exact_sum", "hash32", "hash_bucket", "long_rows", "money_units", "to_money"]
