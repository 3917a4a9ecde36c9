"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line is removed where an equal line stands earlier, or where a near line has its first place earlier. Places are
ordered by doc_id and line number. Lines are compared without white space at their ends; blank lines always stay.

Near lines: two lines are near within one edit per ``CHARS_PER_EDIT`` characters of the shorter one, and ``THRESHOLD``
edits at most; lines too short for an edit are near if equal. A line whose length allows t edits is split into t + 1
segments. A near line that is as long or longer holds at least one of them unchanged, near the same position, so it is
enough to look up, for every length in reach, the few substrings that can be that segment. Candidates are verified
with a banded bit-parallel edit distance.

Defined cases: NULL and empty text has no lines to remove and is returned as it is; rows without doc_id come after
all ids below 2**62, in order of a hash of their texts; repeated rows have the same places and do not remove each other's lines; other columns pass through untouched; all
documents stay, even without lines.
"""

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import bucketed, cut

THRESHOLD = 2
CHARS_PER_EDIT = 10
_BLANKS = " \t\x0b\x0c\r"


def segment(length: Column, i: int, threshold: int) -> tuple[Column, Column]:
    """(start from 0, length) of segment ``i`` of a line: equal parts, the longer ones last."""
    n = threshold + 1
    base, shorter = F.floor(length / n), n - length % n
    return i * base + F.greatest(F.lit(0), i - shorter), base + (i >= shorter).cast("int")


def allowed(length: Column, threshold: int, per_edit: int) -> Column:
    """Edits that a line of this length allows to lines that are as long or longer."""
    return F.least(F.lit(threshold), F.floor(length / per_edit))


def segment_keys(line: Column, length: Column, threshold: int, per_edit: int = CHARS_PER_EDIT) -> list[Column]:
    """(key, role) structs: role 0 for the line's own segments, 1 for substrings looked up among segments of lines
    that are shorter or as long. A substring at its own place among lines of its length is a segment itself."""
    out = []
    for edits in range(1, threshold + 1):
        for gap in range(edits + 1):
            reached = allowed(length - gap, threshold, per_edit) == edits
            for i in range(edits + 1):
                start, size = segment(length - gap, i, edits)
                left, right = i, edits - i
                for shift in range(max(-left, gap - right), min(left, gap + right) + 1):
                    own = gap == 0 and shift == 0
                    part = F.substring(line, (start + shift + 1).cast("int"), size.cast("int"))
                    key = F.xxhash64((length - gap).cast("int"), F.lit(i), part)
                    fits = reached if own else reached & (start + shift >= 0) & (start + shift + size <= length)
                    out.append(F.when(fits, F.struct(key.alias("key"), F.lit(int(not own)).alias("role"))))
    return out


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance of two strings is at most ``threshold``.

    Bit o of level d says that the first i characters of ``a`` reach the first i + o - threshold of ``b`` with at
    most d edits. One step over a character of ``a`` updates the band of all levels with shifts and masks.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    # A function over an array sees it once; looking places up inside would split the line for every character.
    x, y = F.split(a, ""), F.concat(F.array_repeat(F.lit(""), threshold), F.split(b, ""))
    part = lambda o: F.slice(y, o + 1, F.greatest(F.length(a), F.lit(0)))
    same = lambda bit: lambda c, d: F.when(c == d, F.lit(bit)).otherwise(F.lit(0))
    bits = [F.zip_with(F.slice(x, 1, F.length(a)), part(o), same(1 << o)) for o in range(width)]
    matches = bits[0]
    for more in bits[1:]:
        matches = F.zip_with(matches, more, lambda c, d: c + d)
    level = lambda state, d: F.shiftright(state, d * width).bitwiseAND(F.lit(full).cast("long"))

    def step(state, m):
        out, before, after = None, None, None
        for d in range(threshold + 1):
            now = level(state, d)
            new = now.bitwiseAND(m)
            if d:
                new = new.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(after, 1)).bitwiseAND(F.lit(full).cast("long"))
            before, after = now, new
            out = new if out is None else out.bitwiseOR(F.shiftleft(new, d * width))
        return out

    # With no character read, d insertions reach offsets up to d.
    start = sum(sum(1 << (threshold + o) for o in range(d + 1)) << (d * width) for d in range(threshold + 1))
    end = F.aggregate(matches, F.lit(start).cast("long"), lambda s, m: step(s, m.cast("long")))
    reached = F.call_function("shiftright", level(end, threshold), F.length(b) - F.length(a) + threshold).bitwiseAND(F.lit(1).cast("long")) == 1
    near = F.abs(F.length(a) - F.length(b)) <= threshold
    return near & F.when(F.length(a) == 0, F.length(b) <= threshold).otherwise(reached)


def _kept_places(lines: Column, removed: Column) -> Column:
    return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(removed, F.array().cast("array<int>")))


def letter_parity(line: Column) -> Column:
    """64 bits: which letters, by code modulo 64, occur an odd number of times. An edit flips two of them at most."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)
    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), lambda s, c: s.bitwiseXOR(bit(c)))


def _clean(line: Column) -> Column:
    # Few lines hold other blanks than spaces; translating is slow and left to them.
    odd = functools.reduce(operator.or_, [F.contains(line, F.lit(b)) for b in _BLANKS if b != " "])
    return F.trim(F.when(odd, F.translate(line, _BLANKS, " " * len(_BLANKS))).otherwise(line))


def _by_doc(places: DataFrame, name: str) -> DataFrame:
    """One array of (copy, pos) per doc, no longer than the document has lines."""
    return places.groupBy("doc").agg(F.collect_set(F.struct("copy", "pos")).alias(name))


def _of_copy(places: str) -> Column:
    return F.transform(F.filter(places, lambda p: p["copy"] == F.col("copy")), lambda p: p["pos"])


def _repeated(lines: DataFrame) -> DataFrame:
    """(doc, copy, pos) of the lines that have an equal line earlier."""
    place = F.col("doc").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("pos")
    occ = lines.where("line <> ''").select("doc", "copy", "pos", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"), place.alias("place"))
    first = occ.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return occ.join(first, ["h1", "h2"]).where("place <> first").select("doc", "copy", "pos")


def _near(lines: DataFrame, laid: DataFrame, threshold: int, per_edit: int) -> DataFrame:
    """(doc, copy, pos) of the lines among ``lines`` (all different) that have a near line earlier."""
    # A shorter line allows no edit, and is no longer than those that do.
    measured = lines.withColumn("length", F.length("line")).where(F.col("length") >= per_edit)
    keys = F.array_compact(F.array(*segment_keys(F.col("line"), F.col("length"), threshold, per_edit)))
    rows = measured.select("doc", "copy", "pos", F.inline(keys))
    # Most keys have one line only. They go before anything is joined.
    group = Window.partitionBy("key")
    rows = rows.withColumns({"n": F.count("*").over(group), "role0": F.min("role").over(group)}).where("n > 1 and role0 = 0")
    rows = cut(rows.select("key", "role", "doc", "copy", "pos"), "line-keys")
    # The texts come to the rows before the join, so that it makes near pairs only, not the pairs of a frequent segment.
    wanted = _by_doc(rows.select("doc", "copy", "pos"), "wanted")
    own = F.transform(F.array_distinct(_of_copy("wanted")), lambda p: F.struct(p.alias("pos"), _clean(F.get(F.col("row.text"), p)).alias("line")))
    texts = laid.where("lead").join(wanted, "doc").select("doc", "copy", F.inline(own)).select(F.struct("doc", "copy", "pos").alias("place"), "line")
    texts = cut(texts.withColumn("sketch", letter_parity(F.col("line"))), "line-texts")
    rows = cut(rows.select("key", "role", F.struct("doc", "copy", "pos").alias("place")).join(texts, "place"), "line-rows")
    side = lambda c: [F.col(x).alias(f"{x}_{c}") for x in ("place", "line", "sketch")]
    a = rows.where("role = 0").select(F.col("key").alias("key_a"), *side("a"))
    b = rows.select(F.col("key").alias("key_b"), "role", *side("b"))
    order = lambda c: F.struct(F.col(f"place_{c}.doc"), F.col(f"place_{c}.pos"))
    earlier = order("a") < order("b")
    near = (F.col("key_a") == F.col("key_b")) & (order("a") != order("b")) & ((F.col("role") == 1) | earlier)
    near = near & (F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= 2 * threshold)
    # The line of the indexed segment is the shorter one.
    edits = allowed(F.length("line_a"), threshold, per_edit)
    close = within_edits(F.col("line_a"), F.col("line_b"), threshold)
    for fewer in range(1, threshold):
        close = F.when(edits == fewer, within_edits(F.col("line_a"), F.col("line_b"), fewer)).otherwise(close)
    pairs = a.join(b, near & close)
    return pairs.select(F.when(earlier, F.col("place_b")).otherwise(F.col("place_a")).alias("y")).select("y.*").distinct()


def marked_lines(docs: DataFrame, threshold: int = THRESHOLD, per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """``row`` (the document, its ``text`` an array of lines), ``repeats`` and ``nears``: the numbers of the lines that
    go, from 0."""
    # The table holds the lines as an array, so that no later expression splits a text again.
    laid = bucketed(docs.withColumn("text", F.split("text", "\n")), "lines")
    text = F.col("row.text")
    cells = F.transform(text, lambda line, i: F.struct(i.alias("pos"), _clean(line).alias("line")))
    repeats = cut(_by_doc(_repeated(laid.where("lead").select("doc", "copy", F.inline(cells))), "repeats"), "line-repeats")
    marked = laid.join(repeats, "doc", "left").withColumn("repeats", F.coalesce(_of_copy("repeats"), F.array().cast("array<int>")))
    first = F.transform(_kept_places(text, F.col("repeats")), lambda p: F.struct(p.alias("pos"), _clean(F.get(text, p)).alias("line")))
    firsts = marked.where("lead").select("doc", "copy", F.inline(first)).where("line <> ''")
    nears = cut(_by_doc(_near(firsts, laid, threshold, per_edit), "nears"), "line-nears")
    marked = marked.join(nears, "doc", "left").withColumn("nears", F.coalesce(_of_copy("nears"), F.array().cast("array<int>")))
    return marked.select("row", "repeats", "nears")


def _kept_text():
    lines = F.col("row.text")
    kept = F.transform(_kept_places(lines, F.concat("repeats", "nears")), lambda p: F.get(lines, p))
    return F.array_join(F.when(lines.isNotNull(), kept), "\n")


def deduplicated_lines(docs: DataFrame, threshold: int = THRESHOLD, per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """The documents, with their columns, without the lines that go."""
    rows = marked_lines(docs, threshold, per_edit).withColumn("text", _kept_text())
    out = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in out:
        out["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(c) for c, v in out.items()])


def line_report(docs: DataFrame, threshold: int = THRESHOLD, per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """doc_id, n_lines, n_repeated, n_near (lines that go) and text (what stays) per document."""
    rows = marked_lines(docs.select("doc_id", "text"), threshold, per_edit)
    return rows.select(
        "row.doc_id", F.coalesce(F.size("row.text"), F.lit(0)).alias("n_lines"),
        F.size("repeats").alias("n_repeated"), F.size("nears").alias("n_near"), _kept_text().alias("text"),
    )
