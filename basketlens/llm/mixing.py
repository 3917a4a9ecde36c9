"""Mixing sources to target weights by a low-discrepancy schedule.

A slot of the mix takes one block of words. Slot i looks up the fractional part of (i + 1) times the golden ratio
in the cumulative shares, which names its source; the slots of a source are ranked, and rank r takes
block r mod (number of blocks) of the source's shuffled documents. The blocks of a source hold equal numbers of words, save
the last; a source of few words has shorter ones. Its target in blocks, rounded, is its number of slots, one at least:
slots that the points give beyond it go to the sources that they leave short.

Defined cases: a NULL text has size 0; NULL is a source of its own, sorted last; documents of size 0 take nothing;
an empty table gives an empty mix; repeated rows are documents of their own.
"""

import itertools
import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import cut, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 128
# A source has so many blocks at least, as far as it has words.
MIN_BLOCKS = 32
# About so many documents are ordered together in a bucket of the shuffle.
BUCKET_DOCS = 2048
# So many slots are ranked together.
CHUNK_SLOTS = 1 << 16
GOLDEN = (math.sqrt(5) - 1) / 2


def fill_targets(sizes: Sequence[int], weights: Sequence[float], max_repeats: float = MAX_REPEATS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; a share stops at ``max_repeats`` times its size and the rest is
    shared again by weight, until none is above."""
    total, open_ = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    left = total
    while open_:
        weight = math.fsum(weights[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * weights[i] / weight > max_repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(max_repeats * sizes[i])
        open_ -= set(over)
        left = total - math.fsum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: float = MAX_REPEATS) -> list[tuple]:
    """(source, n_docs, source_size, target) per source in code-point order, NULL last. The number of sources is
    what a mix names by hand, so the list is small."""
    rows = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-32-be")))
    targets = fill_targets([r["source_size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], max_repeats)
    return [(r["source"], r["n_docs"], r["source_size"], t) for r, t in zip(rows, targets)]


def block_lengths(targets: Sequence[tuple], block_words: int = BLOCK_WORDS) -> list[int]:
    """Words of a block per source."""
    return [max(1, min(block_words, math.ceil(t[2] / MIN_BLOCKS))) for t in targets]


def slot_counts(targets: Sequence[tuple], lengths: Sequence[int], max_repeats: int = MAX_REPEATS) -> list[int]:
    """Slots per source: whole passes over its blocks, then the blocks of the words that are left of its target."""
    out = []
    for (_, _, size, target), length in zip(targets, lengths):
        blocks = math.ceil(size / length)
        passes = math.floor(target / size) if size else 0
        slots = passes * blocks + min(blocks, round((target - passes * size) / length))
        out.append(min(max_repeats * blocks, max(slots, 1)) if target > 0 else 0)
    return out


def _listed(values: Sequence, kind: str) -> Column:
    """The values as one constant array, so that the plan does not grow with the number of sources."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _by_src(values: Sequence, kind: str = "long") -> Column:
    """The value of a row's source."""
    return F.get(_listed(values, kind), F.col("src"))


def _count_reached(bounds: Sequence[float], point: Column) -> Column:
    """How many of the ascending bounds are at most ``point``, by halving steps."""
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    ends = _listed(bounds, "double")
    fits = lambda low, step: (low + step <= len(bounds)) & (F.get(ends, low + step - 1) <= point)
    return F.aggregate(_listed(steps, "int"), F.lit(0), lambda low, step: F.when(fits(low, step), low + step).otherwise(low))


def _ranked(slots: DataFrame) -> DataFrame:
    """``source_rank`` for (slot, src). Ranks are counted inside chunks of slots, then the chunks' counts are added up:
    no task ranks a whole source."""
    slots = slots.withColumn("chunk", F.floor(F.col("slot") / CHUNK_SLOTS))
    within = Window.partitionBy("chunk", "src").orderBy("slot")
    counts = slots.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("src", "chunk", (F.sum("n").over(Window.partitionBy("src").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = slots.withColumn("in_chunk", F.row_number().over(within) - 1).join(before, ["src", "chunk"])
    return ranked.select("slot", "src", (F.col("before") + F.col("in_chunk")).alias("source_rank"))


def schedule(spark, targets: Sequence[tuple], block_words: int = BLOCK_WORDS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(slot, src, source_rank, epoch, block): the order of the mix. ``src`` is the place in ``targets``."""
    lengths = block_lengths(targets, block_words)
    wanted = slot_counts(targets, lengths, max_repeats)
    n_slots = sum(wanted)
    last = max((i for i, n in enumerate(wanted) if n), default=0)
    bounds = [reached / n_slots for reached in itertools.accumulate(wanted[:last])]
    point = F.expr(f"((slot + 1D) * {GOLDEN!r}D) - floor((slot + 1D) * {GOLDEN!r}D)")
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", point)
    slots = slots.select("slot", _count_reached(bounds, F.col("point")).alias("src"))
    # The points miss a share by a few slots. A source's last ones beyond its number are numbered, and go to those that lack some.
    given = {r["src"]: r["count"] for r in slots.groupBy("src").count().collect()}
    extra = [max(0, given.get(i, 0) - n) for i, n in enumerate(wanted)]
    lacking = [i for i, n in enumerate(wanted) for _ in range(n - given.get(i, 0))]
    if lacking:
        over = F.col("source_rank") - _by_src(wanted)
        number = over + _by_src([0, *itertools.accumulate(extra[:-1])])
        moved = F.get(_listed(lacking, "int"), number.cast("int"))
        slots = cut(_ranked(slots).select("slot", F.when(over >= 0, moved).otherwise(F.col("src")).alias("src")), "mix-slots")
    blocks = _by_src([math.ceil(t[2] / n) for t, n in zip(targets, lengths)])
    ranked = _ranked(slots).withColumn("n_blocks", blocks)
    ranked = ranked.withColumn("epoch", F.floor(F.col("source_rank") / F.col("n_blocks")))
    return ranked.select("slot", "src", "source_rank", "epoch", (F.col("source_rank") % F.col("n_blocks")).alias("block"))


def shuffled_places(sized: DataFrame, targets: Sequence[tuple], key: Column) -> DataFrame:
    """``sized`` with ``src`` and ``start``: the words of its source that come before it in shuffled order.

    ``key`` is a hexadecimal digest. A source is cut into buckets by its first digits; documents are ordered
    inside buckets and the buckets' sums are added up, so a large source is spread like small ones.
    """
    # A local table of one row per source, whose size the optimizer knows.
    names = pa.table({"name": pa.array([t[0] for t in targets], pa.string()), "src": pa.array(range(len(targets)), pa.int32())})
    sources = sized.sparkSession.createDataFrame(names)
    buckets = _by_src([max(1, math.ceil(t[1] / BUCKET_DOCS)) for t in targets])
    keyed = sized.join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn("key", key)
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("bucket", F.floor(share * buckets / (1 << 32)))
    order = Window.partitionBy("src", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = keyed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("src", "bucket", (F.sum("words").over(Window.partitionBy("src").orderBy("bucket")) - F.col("words")).alias("before"))
    placed = keyed.withColumn("in_bucket", F.sum("size").over(order) - F.col("size")).join(before, ["src", "bucket"])
    return placed.withColumn("start", F.col("before") + F.col("in_bucket")).drop("key", "bucket", "before", "in_bucket")


def mix(docs: DataFrame, whole: bool = False, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, seed: str = "mix"):
    """(targets, rows). A row is a document: ``doc_id``, ``source``, ``size``, ``src``, with ``whole`` the
    document itself as ``row``, and ``takes``, the words taken in each epoch; inside an epoch they are the document's first words."""
    spark = docs.sparkSession
    carry = [F.struct(*docs.columns).alias("row")] if whole else []
    sized = docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("text_key"))
    if not carry:
        sized = cut(sized, "mix-sizes")  # the texts are parsed once for both passes
    targets = source_targets(sized, weights, max_repeats)
    nothing = F.array_repeat(F.lit(0).cast("long"), max_repeats)
    if not targets:
        return targets, sized.drop("text_key").withColumns({"src": F.lit(0), "takes": nothing})
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_key"))
    placed = cut(shuffled_places(sized, targets, key).drop("text_key"), "mix-places")
    # (src, start) names a document that has words; the others take nothing.
    lasting = placed.where("size > 0").select("src", "start", "size")
    words = _by_src(block_lengths(targets, block_words))
    first, end = F.floor(F.col("start") / words), F.floor((F.col("start") + F.col("size") - 1) / words)
    cells = lasting.withColumn("block", F.explode(F.sequence(first, end)))
    times = schedule(spark, targets, block_words, max_repeats).groupBy("src", "block").agg(F.count("*").alias("times"))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * words) - F.greatest(F.col("start"), F.col("block") * words)
    sums = [F.sum(F.when(F.col("times") > e, F.col("overlap")).otherwise(0)).alias(f"e{e}") for e in range(max_repeats)]
    takes = cells.withColumn("overlap", overlap).join(times, ["src", "block"]).groupBy("src", "start").agg(*sums)
    takes = takes.select("src", "start", F.array(*[f"e{e}" for e in range(max_repeats)]).alias("takes"), F.lit(True).alias("lasting"))
    rows = placed.withColumn("lasting", F.col("size") > 0).join(takes, ["src", "start", "lasting"], "left")
    return targets, rows.withColumn("takes", F.coalesce("takes", nothing)).drop("start", "lasting")


def mixed_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken per document."""
    targets, rows = mix(docs)
    return rows.select(
        "doc_id", "size", _by_src([t[2] for t in targets]).alias("source_size"),
        _by_src([t[3] for t in targets], "double").alias("target"),
        F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row per document and epoch that takes any of it. A
    document that the end of the mix cuts keeps its first words, joined by single spaces."""
    _, rows = mix(docs, whole=True)
    rows = rows.select("*", F.explode("takes").alias("take")).where("take > 0")
    words = F.split(F.trim(F.regexp_replace("row.text", "[\\x20\\x09-\\x0D]+", " ")), " ")
    cut_text = F.array_join(F.slice(words, 1, F.col("take").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("take") < F.col("size"), cut_text).otherwise(F.col("row.text")))
    out = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in out:
        out["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(c) for c, v in out.items()])
