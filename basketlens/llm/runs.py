"""Runs of repeated words in a text, by the dictionary of basic factors.

Factors of length 1, 2, 4, ... get a name each; a name of twice the length is the pair of the names of its halves.
Places whose factor occurs only once in their document leave: no longer factor of theirs occurs twice. The factor of
length l at a place and its successor, the next place of the same name, lie in a stretch of twice that length if they
are at most l apart. In a run of period q with l / 2 < q <= l, every factor's successor is exactly q places on, so that
its places form an arithmetic progression that proposes the period, for one place after another. Such places are put
together; they span the whole run, as one more equal word on either side would have continued them. A period is taken
at its own level only, so that no run is found twice.

The documents of a block of rows are named together; names never meet across documents. Memory is a few numbers
per word of the block, whatever the number of levels.

Defined cases: NULL, empty and blank text has no words, no runs and an empty collapsed text; rows are independent, so
that repeated rows and NULL doc_ids have results of their own; an empty table gives an empty one; of the columns only
those in ``keep`` go on.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that are named together; a longer document is a block of its own.
BLOCK_WORDS = 1 << 18

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _named(keys: np.ndarray, places: np.ndarray):
    """Of ``places`` with ``keys``, those whose key occurs twice: (in order of key and place, names, same key as the next)."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    same = keys[1:] == keys[:-1]
    twice = np.append(same, False) | np.append(False, same)
    names = np.cumsum(np.append(True, ~same)[: len(keys)])
    keep = np.flatnonzero(twice)
    return places[keep], names[keep], np.append(same, False)[keep]


def word_runs(names: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs in a string of word names.

    Equal words of one document have equal names, words of different documents never."""
    if exponent < 3:
        raise ValueError("exponent must be at least 3")
    found = [np.zeros((0, 3), np.int64)]
    level = np.full(len(names), -1, np.int64)
    places, keys, length = np.arange(len(names)), names, 1
    while len(places):
        places, keys, same = _named(keys, places)
        gap = np.diff(places, append=0)
        near = np.flatnonzero(same & (gap <= length) & (gap > length // 2))
        found.append(_stretches(places[near], gap[near], length, min_length, exponent))
        # The next level: pairs of names, of places where both are left.
        level[:] = -1
        level[places] = keys
        places = np.sort(places)
        places = places[places + length < len(names)]
        right = level[places + length]
        places, right = places[right >= 0], right[right >= 0]
        keys = level[places] * (len(names) + 1) + right
        length *= 2
    found = np.concatenate(found)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _stretches(places, gaps, length, min_length, exponent):
    """Neighbouring places with one gap, put together to runs that are long enough."""
    order = np.argsort(places)
    places, gaps = places[order], gaps[order]
    first = np.append(True, (np.diff(places) != 1) | (np.diff(gaps) != 0))[: len(places)]
    last = np.append(first[1:], True)[: len(places)]
    start, period = places[first], gaps[first]
    size = places[last] - start + length + period
    keep = size >= np.maximum(min_length, exponent * period)
    return np.column_stack([start, size, period])[keep]


def _block(words: list[list[bytes]], min_length: int, exponent: int):
    """Arrow arrays n_words, runs and collapsed of a block of documents."""
    names, known = [], 0
    for doc in words:
        codes = {}
        names.append(np.fromiter((codes.setdefault(w, len(codes)) for w in doc), np.int64, len(doc)) + known)
        known += len(codes)
    ends = np.cumsum([len(doc) for doc in words])
    begins = ends - [len(doc) for doc in words]
    runs = word_runs(np.concatenate(names), min_length, exponent)
    start, size, period = runs.T
    change = np.zeros(ends[-1] + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    kept = np.cumsum(change[:-1]) == 0
    texts = [b" ".join(itertools.compress(doc, kept[a:b])) for doc, a, b in zip(words, begins, ends)]
    owner = np.searchsorted(ends, start, "right")
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(words))))
    columns = [pa.array(start - begins[owner]), pa.array(size), pa.array(period)]
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(RUN)))
    return pa.array(ends - begins, pa.int64()), listed, pa.array(texts, pa.binary()).cast(pa.string())


def collapsed_runs(docs: DataFrame, text: str = "text", keep=("doc_id",), min_length: int = 6, exponent: int = 4) -> DataFrame:
    """The ``keep`` columns, ``n_words``, ``runs`` and ``collapsed`` per row.

    A run is a longest stretch of words with smallest period q, of at least ``min_length`` words and ``exponent``
    (3 or more) times q. ``runs`` lists (start, length, period) by start and period. ``collapsed`` is the
    text without the words that follow the first q of a run, joined by single spaces."""

    def run(batches):
        for batch in batches:
            words, size, first = [], 0, 0
            for i, value in enumerate(batch.column(len(keep)).cast(pa.binary())):
                words.append((value.as_py() or b"").split())  # at the six ASCII white-space characters
                size += len(words[-1])
                if size >= BLOCK_WORDS or i == batch.num_rows - 1:
                    kept = [batch.column(j).slice(first, len(words)) for j in range(len(keep))]
                    found = _block(words, min_length, exponent)
                    yield pa.RecordBatch.from_arrays([*kept, *found], [*keep, "n_words", "runs", "collapsed"])
                    words, size, first = [], 0, i + 1

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    out = f"{kinds}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, out)


def run_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period), and digests of the runs and the collapsed text."""
    found = collapsed_runs(docs, **options)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_cycles(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document, by the CRC-32 of its doc_id, ends in words that go round.

    With h that CRC, g = h // 10 and n words, words from a = g % n on become the p words there over and over, where
    p = 1 + (n - a) // (3 + g % 8). Documents without doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    docs = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    docs = docs.withColumn("a", F.when(n > 0, g % n).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    head = F.slice("words", 1, F.col("a"))
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), (3 + g % 8).cast("int")))
    changed: Column = F.array_join(F.slice(F.concat(head, cycle), 1, n), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
