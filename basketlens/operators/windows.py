"""Training examples: windows of a customer's document."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions import hash32
from basketlens.operators.documents import item, length, sequence
from basketlens.schema import CUSTOMER

METHODS = ("dm", "dbow")
RUNS = "unknown_runs"

# So many positions of a document are unfolded by one row; a longer document is dealt out in blocks.
BLOCK = 1 << 16


def check_window(method: str, window: int) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if window < 1:
        raise ValueError("window must be at least 1")
    if method == "dm" and window % 2:
        raise ValueError("window must be even")


def eligible(docs: DataFrame, window: int) -> DataFrame:
    """Documents with more than ``window`` products; shorter ones give no example."""
    return docs.where(length() > window)


def _code() -> Column:
    """The customer in hashes; empty for the anonymous one, where it is kept."""
    return F.coalesce(F.col(CUSTOMER), F.lit(""))


def _first(method: str, window: int) -> int:
    return window // 2 if method == "dm" else 0


def _decoded(docs: DataFrame, first: Column | None = None, count: int | None = None) -> DataFrame:
    """Documents in an order of their own as ``_part``, an array of their products or of ``count`` of them, which begins
    at ``_base``; other documents stay as they are."""
    if RUNS not in docs.columns:
        return docs
    whole, base = sequence(ordered=True), F.lit(0) if first is None else F.greatest(first, F.lit(0))
    part = whole if count is None else F.slice(whole, base + 1, F.lit(count))
    return docs.withColumns({"_part": part, "_base": base.cast("int")})


def _reader(docs: DataFrame):
    """The function from a position to its product."""
    return (lambda position: F.get("_part", position - F.col("_base"))) if "_part" in docs.columns else item


def _around(position: Column, window: int, item=item) -> Column:
    """The products on both sides of a position, half a window each."""
    half = window // 2
    steps = [*range(-half, 0), *range(1, half + 1)]
    return F.array(*[item(position + s) for s in steps])


def _ahead(position: Column, window: int, item=item) -> Column:
    """The ``window`` products from a position on."""
    return F.array(*[item(position + s) for s in range(window)])


def _unfolded(docs: DataFrame, name: str, first: Column, last: Column, window: int) -> DataFrame:
    """``docs`` with a row per position. Blocks of positions are shuffled as documents, before they are
    unfolded, so a customer with millions of products is neither one array nor one task."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = docs.withColumn("_block", F.explode(F.sequence(first, last, F.lit(BLOCK)))).repartition(n, CUSTOMER, "_block")
    end = F.least(F.col("_block") + (BLOCK - 1), last)
    if RUNS in docs.columns:  # a block reads its own part of the document
        blocks = _decoded(blocks.withColumn("_end", end), F.col("_block") - window, BLOCK + 2 * window)
        blocks, end = blocks.select(CUSTOMER, "_block", "_end", "_part", "_base"), F.col("_end")
    return blocks.withColumn(name, F.explode(F.sequence(F.col("_block"), end))).drop("_block")


def dm_pairs(docs: DataFrame, window: int = 8) -> DataFrame:
    """(CUST_CODE, target_pos, context, target): every centre product with its neighbours on both sides."""
    check_window("dm", window)
    half = window // 2
    rows = _unfolded(eligible(docs, window), "target_pos", F.lit(half), length() - half - 1, window)
    position, at = F.col("target_pos"), _reader(rows)
    return rows.select(
        CUSTOMER, "target_pos", _around(position, window, at).alias("context"), at(position).alias("target")
    )


def dbow_pairs(docs: DataFrame, window: int = 8, include_last: bool = False) -> DataFrame:
    """(CUST_CODE, start_pos, context): every run of ``window`` products.

    The run that ends with the last product is left out unless ``include_last``.
    """
    check_window("dbow", window)
    last = length() - window - (0 if include_last else 1)
    rows = _unfolded(eligible(docs, window), "start_pos", F.lit(0), last, window)
    return rows.select(CUSTOMER, "start_pos", _ahead(F.col("start_pos"), window, _reader(rows)).alias("context"))


def epoch_sample(
    docs: DataFrame, window: int = 8, method: str = "dm", epoch: int = 0, seed: int = 1, keep=()
) -> DataFrame:
    """One example per eligible customer: (CUST_CODE, pos, context, target, kept columns), target NULL for dbow.

    The position is drawn by a hash of seed, epoch and customer, evenly over all windows, so each
    epoch sees every customer once and a rerun draws the same examples on any layout.
    """
    check_window(method, window)
    draw = hash32(seed, epoch, _code()) % (length() - window).cast("bigint")
    rows = _decoded(eligible(docs, window)).withColumn("pos", (draw + _first(method, window)).cast("int"))
    position, at = F.col("pos"), _reader(rows)
    if method == "dm":
        context, target = _around(position, window, at), at(position)
    else:
        context, target = _ahead(position, window, at), F.lit(None).cast("int")
    return rows.select(CUSTOMER, "pos", context.alias("context"), target.alias("target"), *keep)


def epoch_windows(docs: DataFrame, window: int, method: str, epoch: int, seed: int, count: int, keep=()) -> DataFrame:
    """``count`` examples per eligible customer in one row: (CUST_CODE, contexts, targets, kept columns).

    They are the examples that ``epoch_sample`` draws in epochs ``epoch * count`` and following. ``contexts`` holds
    them one after another; ``targets`` has one product each and is NULL for dbow.
    """
    check_window(method, window)

    def place(i):
        draw = hash32(seed, (i + epoch * count).cast("string"), _code()) % (length() - window).cast("bigint")
        return (draw + _first(method, window)).cast("int")

    rows = _decoded(eligible(docs, window)).withColumn("_places", F.transform(F.sequence(F.lit(0), F.lit(count - 1)), place))
    around = _around if method == "dm" else _ahead
    at = _reader(rows)
    contexts = F.flatten(F.transform("_places", lambda p: around(p, window, at)))
    targets = F.transform("_places", at) if method == "dm" else F.lit(None).cast("array<int>")
    return rows.select(CUSTOMER, contexts.alias("contexts"), targets.alias("targets"), *keep)
