"""Removal of repeated byte strings by prefix doubling over sampled positions.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a smaller doc_id, or in
the same document at an earlier place.

Prefix doubling names the strings at all positions at growing offsets: the name of 2n bytes is the pair of the names
of n bytes at a place and n further on. Positions whose name is unique drop out. Sorting every byte position
in every round would move some thirty times the input, so the positions are thinned first, without loss:

1. A task doubles the names of its own texts to ``GRAM`` = 32 bytes. Every string of 100 bytes is represented by its smallest
   name, an anchor; equal strings have equal anchors at equal places. One position in 35 is an anchor.
2. Spark sorts the anchors by the pair (name of 32 bytes, name of the whole range that the anchor's strings cover, which
   is past the threshold) and place. Anchors that are unique drop out. Where the pair stands earlier, all strings
   of the anchor do. What is left are anchors with several ranges under one name: the edges of repeats.
3. For these the strings of exactly 100 bytes are named, sorted and ranked. They lie together by anchor; an anchor with very
   many ranges hands its strings to a further sort by their names.

Names are 64-bit hashes, and two texts are taken as equal where an anchor's name and a second name agree.

Defined cases: NULL and empty text has no bytes; matches never cross documents; rows without doc_id come after
all ids below 2**62, in order of a hash of their texts; rows that share a doc_id are ordered by place alone, so repeated rows do not remove each other; other columns are
ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import bucketed, cut

LENGTH = 100
GRAM = 32
SPREAD = LENGTH - GRAM  # the anchor starts up to so many bytes into a string
_PLACE = 24
_CHUNK = 1 << 23
# Ranges of one anchor that a task ranks by itself.
RUN_ROWS = 20_000
_U = np.uint64
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)


def grams(data: np.ndarray) -> np.ndarray:
    """Names of the 32 bytes from every position, doubled from single bytes."""
    h = _BYTES[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * _A + (h[step:] ^ (h[step:] >> _U(31))) * _B
        h ^= h >> _U(29)
    return h


def _join(names) -> np.ndarray:
    out = _U(0)
    for n in names:
        out = (out ^ n) * _C
        out ^= out >> _U(32)
    return out


def anchors(data: np.ndarray):
    """(name, range name, anchor place, first, last): per anchor, where the strings that it represents start."""
    h = grams(data)
    n = len(h) - SPREAD
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    mask = _U((1 << _PLACE) - 1)
    low = (h & ~mask) | (mask - np.arange(len(h), dtype=np.uint64))  # equal names: the last place is the smallest
    for step in (1, 2, 4, 8, 16, 32):
        low = np.minimum(low[:-step], low[step:])
    more = SPREAD + 1 - 64
    low = np.minimum(low[:n], low[more : more + n])
    at = (mask - (low & mask)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.append(first[1:], n) - 1
    at = at[first]
    end = last + LENGTH - GRAM
    pieces = [h[np.minimum(first + GRAM * t, end)] for t in range(-(-(LENGTH + SPREAD) // GRAM))]
    shape = ((last - first) * LENGTH + at - first).astype(np.uint64)
    return (h[at] >> _U(16)).astype(np.int64), _join([shape, *pieces]).astype(np.int64), at, first, last


def _anchor_rows(batches):
    """(h, s, doc, copy, first, count, shift, known) per anchor. Within a batch only the earliest of equal pairs goes to
    its name; the others are known to be repeats and are spread evenly, so that a frequent text is no hot group."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            cols = [[] for _ in range(7)]
            for doc, copy, text in zip(*(part.column(i) for i in range(3))):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                for begin in range(0, max(1, len(data) - LENGTH + 1), _CHUNK):
                    h, s, at, first, last = anchors(data[begin : begin + _CHUNK + LENGTH - 1])
                    if len(h):
                        values = (h, s, np.full(len(h), doc.as_py()), np.full(len(h), copy.as_py()), first + begin, last - first + 1, at - first)
                        for c, v in zip(cols, values):
                            c.append(v)
            if not cols[0]:
                continue
            h, s, doc, copy, first, count, shift = (np.concatenate(c) for c in cols)
            order = np.lexsort((first, doc, s, h))
            same = (h[order][1:] == h[order][:-1]) & (s[order][1:] == s[order][:-1])
            later = same & ((doc[order][1:] != doc[order][:-1]) | (first[order][1:] != first[order][:-1]))
            # Rows of one run are sorted by place, so a row after a change of place has an earlier one.
            run = np.cumsum(np.append(0, ~same))
            known_sorted = np.append(False, later)
            seen = np.maximum.accumulate(np.where(known_sorted, run + 1, 0))
            known = np.zeros(len(h), bool)
            known[order] = seen == run + 1
            h = np.where(known, ((doc.astype(np.uint64) * _A + first.astype(np.uint64)) * _B >> _U(16)).astype(np.int64), h)
            arrays = [pa.array(h), pa.array(s), pa.array(doc), pa.array(copy.astype(np.int32)), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int16)), pa.array(shift.astype(np.int16)), pa.array(known)]
            yield pa.RecordBatch.from_arrays(arrays, ["h", "s", "doc", "copy", "first", "n", "shift", "known"])


def _pieces(batches):
    """The bytes of the ranges that are left: (h, doc, copy, first, n, piece)."""
    for batch in batches:
        out = [[] for _ in range(6)]
        size = 0
        for doc, copy, text, edges in zip(*(batch.column(i) for i in range(4))):
            data = text.as_py().encode()
            for e in edges.as_py():
                values = (e["h"], doc.as_py(), copy.as_py(), e["first"], e["n"], data[e["first"] : e["first"] + e["n"] - 1 + LENGTH])
                for c, v in zip(out, values):
                    c.append(v)
                size += 1
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int16(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["h", "doc", "copy", "first", "n", "piece"])


def _string_names(pieces: list[bytes], counts: np.ndarray):
    """(row, offset, name, second name) of the strings of 100 bytes that start in the rows' pieces."""
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    h = grams(flat)
    base = np.cumsum([0, *map(len, pieces)])[:-1]
    row = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = base[row] + offset
    parts = [h[at], h[at + GRAM], h[at + 2 * GRAM], h[at + SPREAD]]
    return row, offset, _join(parts).astype(np.int64), _join(parts[::-1]).astype(np.int64)


def _rank_strings(batches):
    """Streams rows sorted by h. kind 0: (doc, copy, first, n) strings that stand earlier; kind 1: strings of anchors
    with too many ranges, by name (n is 1)."""
    names = ["kind", "doc", "copy", "first", "n", "name", "name2"]

    def emit(kind, doc, copy, first, n, name, name2):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind, np.int32)), pa.array(doc), pa.array(copy.astype(np.int32)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(name), pa.array(name2)], names)

    def work(t, large):
        h, doc, copy, first, n = (t.column(i).to_numpy() for i in range(5))
        row, offset, name, name2 = _string_names(t.column(5).to_pylist(), n.astype(np.int64))
        place = first[row].astype(np.int64) + offset
        if large:
            return emit(1, doc[row], copy[row], place, np.ones(len(row)), name, name2)
        order = np.lexsort((place, doc[row], name2, name, h[row]))
        k = [a[order] for a in (h[row], name, name2, doc[row], place)]
        same = np.append(False, (k[0][1:] == k[0][:-1]) & (k[1][1:] == k[1][:-1]) & (k[2][1:] == k[2][:-1]))
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        again = np.zeros(len(row), bool)
        again[order] = same & ((k[3] != k[3][head]) | (k[4] != k[4][head]))
        # Neighbouring strings of a row make one range.
        begin = again & ~np.append(False, again[:-1] & (row[1:] == row[:-1]))
        at = np.flatnonzero(begin)
        span = np.add.reduceat(again.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
        zero = np.zeros(len(at), np.int64)
        return emit(0, doc[row][at], copy[row][at], place[at], span, zero, zero)

    kept, large = None, None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        while t is not None and t.num_rows:
            if large is not None:  # the rest of an anchor that is being handed on
                h = t.column(0).to_numpy()
                stop = int(np.searchsorted(h, large, side="right"))
                if stop:
                    yield work(t.slice(0, stop).combine_chunks(), True)
                    t = t.slice(stop)
                    continue
                large = None
            t = pa.concat_tables([kept, t]).combine_chunks() if kept is not None else t
            kept = None
            h = t.column(0).to_numpy()
            last = int(np.searchsorted(h, h[-1], side="left"))
            if last:
                yield work(t.slice(0, last).combine_chunks(), False)
            t = t.slice(last).combine_chunks()
            if t.num_rows > RUN_ROWS:
                large = int(h[-1])
            else:
                kept, t = t, None
    if kept is not None:
        yield work(kept, False)


def _removed(batches):
    """(doc_id, n_bytes, n_removed, n_spans, kept) per document and its repeated strings."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            out = [[] for _ in range(5)]
            for doc_id, text, firsts, counts in zip(*(part.column(i) for i in range(4))):
                data = (text.as_py() or "").encode()
                begin = np.array(firsts.as_py() or [], np.int64)
                end = begin + np.array(counts.as_py() or [], np.int64) - 1 + LENGTH
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
                # A new run starts where a range begins beyond all before it.
                new = np.flatnonzero(np.append(True, begin[1:] > end[:-1])) if len(begin) else np.empty(0, np.int64)
                starts, stops = begin[new], np.append(end[new[1:] - 1], end[-1:]) if len(new) else end
                cuts = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                for c, v in zip(out, (doc_id.as_py(), len(data), len(data) - len(kept), len(starts), kept)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: the bytes that stay) per document."""
    laid = bucketed(docs.select("doc_id", "text"), "suffix")
    spark = docs.sparkSession
    text = F.col("row.text").alias("text")
    leads = laid.where("lead")
    rows = leads.select("doc", "copy", text).mapInArrow(_anchor_rows, "h long, s long, doc long, copy int, first int, n short, shift short, known boolean")
    by_name, by_pair = Window.partitionBy("h"), Window.partitionBy("h", "s").orderBy("doc", "first")
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h")
    rows = rows.withColumns({"doc0": F.first("doc").over(by_pair), "first0": F.first("first").over(by_pair), "rank": F.row_number().over(by_pair)})
    rows = rows.withColumns({"rows": F.count("*").over(by_name), "ranges": F.sum((F.col("rank") == 1).cast("int")).over(by_name)})
    rows = rows.where("rows > 1 or known")
    again = F.col("known") | (F.col("doc") != F.col("doc0")) | (F.col("first") != F.col("first0"))
    rows = cut(rows.withColumn("again", again).where("again or ranges > 1").select("again", "h", "doc", "copy", "first", "n"), "suffix-anchors")

    # Joined on doc alone, which the table is bucketed by.
    edges = rows.where("not again").groupBy("doc").agg(F.collect_list(F.struct("copy", "h", "first", "n")).alias("edges"))
    left = leads.join(edges, "doc").withColumn("edges", F.filter("edges", lambda e: e["copy"] == F.col("copy"))).select("doc", "copy", text, "edges")
    pieces = left.mapInArrow(_pieces, "h long, doc long, copy int, first int, n short, piece binary")
    pieces = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h").sortWithinPartitions("h")
    ranked = cut(pieces.mapInArrow(_rank_strings, "kind int, doc long, copy int, first int, n int, name long, name2 long"), "suffix-strings")

    found = rows.where("again").select("doc", "copy", "first", F.col("n").cast("int").alias("n"))
    found = found.unionByName(ranked.where("kind = 0").select("doc", "copy", "first", "n"))
    wide = ranked.where("kind = 1")
    earliest = cut(wide.groupBy("name", "name2").agg(F.min(F.struct("doc", "first")).alias("m"), F.count("*").alias("c")).where("c > 1").select("name", "name2", "m"), "suffix-first")
    late = wide.join(earliest, ["name", "name2"]).where(F.struct("doc", "first") != F.col("m"))
    found = found.unionByName(late.select("doc", "copy", "first", "n"))
    spans = found.groupBy("doc").agg(F.collect_list(F.struct("copy", "first", "n")).alias("spans"))
    own = F.filter("spans", lambda s: s["copy"] == F.col("copy"))
    rows = laid.join(spans, "doc", "left").withColumn("spans", own)
    rows = rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), text, F.transform("spans", lambda s: s["first"]).alias("firsts"), F.transform("spans", lambda s: s["n"]).alias("counts"))
    return rows.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
