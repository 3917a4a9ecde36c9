"""Fill-in-the-middle: a text is cut in two places of its units, and its parts change order.

Units are code points, or what a pattern matches: a unit then reaches to the next match, the first one back to the start
of the text. The UTF-8 text is seen as blocks of fixed size. A Fenwick tree over the blocks holds how many units and how
many code points start in each; a descent by powers of two finds the block of a cut, and the place is looked up there.

Defined cases: NULL is an empty text; empty texts and those that contain one of the marks stay plain, so that every
output can be read back; draws depend on doc_id and seed only, rows without doc_id share theirs (those of an empty
string); repeated rows have equal results; an empty table gives an empty one; of the columns only doc_id goes on.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM = 90, 20  # percent of texts that are cut, and of these that start with the suffix


class Fenwick:
    """Sums over the first blocks of (units, code points), one row of ``counts`` per block."""

    def __init__(self, counts: np.ndarray):
        total = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)])
        at = np.arange(len(total))
        self.tree = total - total[at - (at & -at)]

    def descend(self, units: int):
        """(block, units before it, code points before it) of the block where unit number ``units`` starts."""
        block, before, points = 0, 0, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            if block + step < len(self.tree) and before + self.tree[block + step, 0] <= units:
                block += step
                before, points = before + int(self.tree[block, 0]), points + int(self.tree[block, 1])
            step >>= 1
        return block, before, points


class UnitText:
    """A text whose places are found by the number of units before them."""

    def __init__(self, data: bytes, pattern=None, block: int = BLOCK):
        self.size, self.block = len(data), block
        self.points = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80  # bytes where a code point starts
        self.units = self.points
        if pattern:
            starts = np.array([m.start() for m in pattern.finditer(data.decode())], np.int64)
            self.units = np.zeros(self.size, bool)
            self.units[np.flatnonzero(self.points)[starts]] = True
            if len(starts):  # the text before the first match is part of the first unit
                self.units[np.flatnonzero(self.units)[0]] = False
                self.units[0] = True
        self.n = int(np.count_nonzero(self.units))
        at = np.arange(0, self.size, block)
        counts = [np.add.reduceat(a, at, dtype=np.int64) if self.size else np.zeros(0, np.int64) for a in (self.units, self.points)]
        self.fenwick = Fenwick(np.column_stack(counts))

    def place(self, units: int):
        """(byte, code points before it) where ``units`` units end."""
        if units <= 0:
            return 0, 0
        if units >= self.n:
            return self.size, int(np.count_nonzero(self.points))
        block, before, points = self.fenwick.descend(units)
        low = block * self.block
        here = int(np.flatnonzero(self.units[low : low + self.block])[units - before])
        return low + here, points + int(np.count_nonzero(self.points[low : low + here]))


def _transformed(data: bytes, draws, pattern, rate: int, spm: int, marks):
    """n, form, prefix_chars, middle_chars and output of a text; ``draws`` are four whole numbers."""
    text = UnitText(data, pattern)
    if not data or any(m in data for m in marks) or draws[2] % 100 >= rate:
        return text.n, "plain", None, None, data
    low, high = sorted(d % (text.n + 1) for d in draws[:2])
    (a, before), (b, points) = text.place(low), text.place(high)
    p, s, m = marks
    if draws[3] % 100 < spm:
        return text.n, "spm", before, points - before, b"".join([s, data[b:], p, data[:a], m, data[a:b]])
    return text.n, "psm", before, points - before, b"".join([p, data[:a], s, data[b:], m, data[a:b]])


def fill_in_middle(
    docs: DataFrame, unit: str | None = None, rate: int = RATE, spm: int = SPM, seed: int = 1, marks=(PREFIX, SUFFIX, MIDDLE)
) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars (code points, NULL if plain) and output.

    ``unit`` is a pattern of the regex module, NULL for code points. ``rate`` percent of the texts are cut, ``spm``
    percent of these begin with their suffix. ``marks`` stand before prefix, suffix and middle."""
    marks_utf8 = tuple(m.encode() for m in marks)

    def run(batches):
        pattern = regex.compile(unit) if unit else None
        for batch in batches:
            draws = [batch.column(i).to_pylist() for i in range(2, 6)]
            texts = batch.column(1).cast(pa.binary())
            found = [_transformed(t.as_py() or b"", d, pattern, rate, spm, marks_utf8) for t, *d in zip(texts, *draws)]
            n, form, prefix, middle, output = zip(*found)
            columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            out = pa.array(output, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, out], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(F.col("doc_id").cast("long"), "text", *draws)
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks=(PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that an output of ``fill_in_middle`` was made of."""
    p, s, m = marks

    def between(left, right):
        return F.substring_index(F.substring_index(output, left, -1), right, 1)

    middle = F.substring_index(output, m, -1)
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def infill_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and digests of the output and of the text read back from it."""
    made = fill_in_middle(docs, **options)
    back = restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)
