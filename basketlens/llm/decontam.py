"""Benchmark decontamination as a prefix-filtered set join, with DataFrame functions only.

A window, some consecutive words of a benchmark item, is a set of placed shingles. A document holds the window only if
it holds all of them, so that one, the rarest in the documents, is the necessary prefix. The documents' shingles are
joined with the rarest shingles; the place of the shingle in its window gives the place where the window would begin
in the document, and the bounds of the document exclude some. What is left is verified on the words themselves.

A window with a shingle that no document holds takes no part in the second pass. Windows that share a rarest shingle
at the same place make one candidate, whatever their number; the words then tell which of them it is.

The tables of shingles are broadcast in parts of at most ``BROADCAST_ROWS`` rows, one pass over the documents for each
part. The words of windows are broadcast below ``BROADCAST_BYTES``, and shuffled otherwise.

Defined cases: NULL, empty texts and texts of other characters have no words; such items have no windows and such
documents no hits; rows are told apart by doc_id and text, so that rows without doc_id have results of their own
and repeated rows equal ones; items that repeat an item_id are one item, items without item_id take part as such: words they hit
count, but they are no items; empty tables give no rows or no hits; other columns are ignored.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import cut

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 1 << 20
BROADCAST_BYTES = 64 << 20

# Words: runs of ASCII letters, digits and all characters beyond ASCII.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    """The words, A-Z in lower case; no other character changes its case."""
    plain = F.octet_length(text) == F.length(text)
    return F.array_remove(F.split(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), BETWEEN_WORDS), "")


def _row_key(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("digest")]


def _shingle(size: int) -> Column:
    """Hash of the ``size`` words from ``pos`` on; the sizes don't meet."""
    return F.xxhash64(F.lit(size), *[F.get("words", F.col("pos") + i) for i in range(size)])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window, length): the distinct windows of every item, their words joined by spaces."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    rows = rows.select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("length"), F.posexplode("words").alias("pos", "word"))
    rows = rows.where("pos + length <= size(words)")
    return rows.select("item_id", F.array_join(F.slice("words", F.col("pos") + 1, F.col("length")), " ").alias("window"), "length").distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(window, length, offset, size, h) per shingle of every window; a window of fewer words is one shingle."""
    rows = windows.select("window", "length", F.split("window", " ").alias("words"))
    rows = rows.select("*", F.posexplode("words").alias("pos", "word"))
    size = F.least(F.col("length"), F.lit(shingle))
    h = F.lit(None)
    for n in range(1, shingle + 1):
        h = F.when(size == n, _shingle(n)).otherwise(h)
    return rows.where(F.col("pos") + size <= F.col("length")).select("window", "length", F.col("pos").alias("offset"), size.alias("size"), h.alias("h"))


def _placed(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """The row key, ``words``, ``pos`` and ``h`` for every shingle of the documents.

    The array of words is passed on by reference up to the next shuffle, so no row may be written between here and it."""
    rows = docs.where("text is not null").select(*_row_key(docs), words(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "digest", "words", F.posexplode("words").alias("pos", "word"))
    if len(sizes) == 1:
        return rows.withColumn("h", _shingle(sizes[0]))
    return rows.withColumn("h", F.explode(F.array(*[_shingle(n) for n in sizes])))


def _in_parts(table: DataFrame, rows: int, limit: int) -> list[DataFrame]:
    """``table`` in parts of about ``limit`` rows by its hash ``h``, each to be broadcast."""
    parts = -(-rows // limit)
    if parts <= 1:
        return [F.broadcast(table)] * parts
    return [F.broadcast(table.where(F.pmod(F.xxhash64("h"), F.lit(parts)) == i)) for i in range(parts)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def window_hits(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """(doc_id, digest, start, length, window) for every occurrence of a window (window, length) in a document.

    NULL if there is none for want of windows or of their shingles."""
    shingles = cut(window_shingles(windows, shingle), "shingles")
    known = cut(shingles.select("h").distinct(), "shingle-set")
    sizes = [r["size"] for r in shingles.select("size").distinct().orderBy("size").collect()]  # at most ``shingle`` of them
    if not sizes:
        return None
    counts = [_placed(docs, sizes).join(part, "h").groupBy("h").count() for part in _in_parts(known, known.count(), broadcast_rows)]
    counts = cut(_union(counts), "shingle-counts")

    # The prefix of a window: its rarest shingle. Those that no document holds end their window.
    order = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "h", "offset")
    rarest = shingles.join(counts, "h", "left").groupBy("window", "length").agg(F.min(order).alias("rarest"))
    prefixes = cut(rarest.where("rarest.n > 0").select("window", "length", "rarest.h", "rarest.offset"), "prefixes")
    places = cut(prefixes.select("h", "offset", "length").distinct(), "prefix-places")
    found = []
    for part in _in_parts(places, places.count(), broadcast_rows):
        start = F.col("pos") - F.col("offset")
        near = _placed(docs, sizes).join(part, "h").where((start >= 0) & (start + F.col("length") <= F.size("words")))
        first = F.greatest(start, F.lit(0))  # the join's filter on NULL may be computed ahead of the bounds
        here = F.array_join(F.slice("words", first + 1, F.col("length")), " ")
        found.append(near.select("doc_id", "digest", start.alias("start"), "length", "h", "offset", here.alias("window")))
    if not found:
        return None
    size = prefixes.agg(F.sum(F.length("window") + 64)).first()[0]
    prefixes = F.broadcast(prefixes) if size <= BROADCAST_BYTES else prefixes
    # A window is found by its own prefix only, hence once at every place.
    return _union(found).join(prefixes, ["window", "length", "h", "offset"]).select("doc_id", "digest", "start", "length", "window")


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """doc_id, n_words, n_hit (words in occurrences of windows), item_ids (sorted as strings) per document."""
    owners = cut(item_windows(items, window), "item-windows")
    base = docs.select(*_row_key(docs), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(ANY_WORD)).cast("long").alias("n_words"))
    hits = window_hits(docs, owners.select("window", "length").distinct(), shingle, broadcast_rows)
    if hits is None:
        return base.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"))
    hits = cut(hits, "hits")
    key = ["doc_id", "digest"]
    end = F.col("start") + F.col("length")
    spans = hits.groupBy(*key, "start").agg(F.max("length").alias("length"))  # repeated rows meet here
    before = F.max(end).over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", end - F.greatest("start", F.coalesce(before, F.lit(0))))
    spans = spans.groupBy(*key).agg(F.sum(F.greatest("new", F.lit(0))).alias("n_hit"))
    size = owners.agg(F.sum(F.length("window") + F.length(F.coalesce("item_id", F.lit(""))) + 64)).first()[0]
    owners = owners.select("window", "item_id")
    owned = hits.select(*key, "window").distinct().join(F.broadcast(owners) if size <= BROADCAST_BYTES else owners, "window")
    owned = owned.groupBy(*key).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))  # the ids of one document's items
    for side, name in ((spans, "n_hit"), (owned, "item_ids")):
        side = side.withColumnsRenamed({c: f"_{c}" for c in key})
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
        base = base.join(side, same, "left").select(*base.columns, name)
    empty = F.array().cast("array<string>")
    return base.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", empty).alias("item_ids"))


def contamination_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, digest of the item ids, and whether there is any hit."""
    found = contaminated(docs, items, **options)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
