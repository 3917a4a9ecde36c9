"""Near-duplicate documents by MinHash: universal hash minima, banding, signature check, components.

Two documents are linked when the Jaccard similarity of their sets of word shingles reaches a threshold. Words are
split at ASCII white space after lower-casing A-Z. A document with fewer words than a shingle is one shingle.

Documents with equal sets form one class, which its smallest id stands for. Classes that agree in a band meet in a
bucket. There each class is first compared with the bucket's smallest id, which settles groups of copies without
pairs among them. Buckets that still hold several components compare the rest, block by block on signatures; what may
be linked makes a family, and the blocks of a family confirm the links that join its components. Every link is
confirmed on whole shingle sets. A block is written once and read by the tasks that compare it with others.

Defined cases: NULL and empty text, or text without words, has an empty set and no links; a row whose doc_id is
NULL has no component and is kept; rows that share a doc_id are versions of one document: a link of one of them is
a link of that doc_id; other columns are ignored.
"""

import io

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import cut, discard, publish, release, shared_folder, sorted_runs, store
from basketlens.llm.components import components, smallest_labels

HASHES = 128
BAND_ROWS = 4
# Two sets with a similarity of 0.8 agree in 102 of 128 minima, give or take 4.5; four such steps are allowed.
SLACK = 18
BLOCK = 1024
# A task compares a block with so many others.
MEETINGS = 16
MEMO_WORDS = 300_000
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Text to the sorted distinct 64-bit codes of its shingles."""

    def __init__(self, words: int):
        self.words, self.memo = words, {}

    def _code(self, word):
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = xxhash.xxh64_intdigest(word)
        return found

    def codes(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode().lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self._code, parts), np.uint64, len(parts))
        k = min(self.words, len(w))
        out = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            out = (out ^ w[i : len(w) - k + 1 + i]) * _P1
            out ^= out >> np.uint64(29)
        return np.unique(out * _P2)


def universal_hashes(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of multiply-shift hashes: the upper 32 bits of a * x + b."""
    rng = np.random.default_rng(seed)
    draw = lambda: rng.integers(0, 1 << 63, (count, 1), dtype=np.uint64) << np.uint64(1)
    return draw() | np.uint64(1), draw()


def minima(codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest hash of the codes per function; a long document is taken in parts, which bounds memory."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(codes), 4096):
        low = np.minimum(low, (a * codes[i : i + 4096] + b).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity, in whole numbers."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def signatures(docs: DataFrame, words: int, hashes: int = HASHES) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set) and signature (binary); both NULL for an empty set."""

    def run(batches):
        shingler = Shingler(words)
        a, b = universal_hashes(hashes)
        for batch in batches:
            n, keys, sigs = [], [], []
            for t in batch.column(1):
                codes = shingler.codes(t.as_py())
                n.append(len(codes))
                keys.append(xxhash.xxh3_128_digest(codes.tobytes()) if len(codes) else None)
                sigs.append(minima(codes, a, b).tobytes() if len(codes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _bands(classes: DataFrame, hashes: int) -> DataFrame:
    """(bucket, band, id) for every band of a class's signature."""
    size = 4 * BAND_ROWS
    codes = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.lit(i), F.substring("signature", 1 + i * size, size)).alias("bucket")) for i in range(hashes // BAND_ROWS)]
    return classes.select("id", F.inline(F.array(*codes)))


def _agreeing(pairs: DataFrame, classes: DataFrame, floor: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    sig = lambda c: classes.select(F.col("id").alias(c), F.col("signature").alias(f"sig_{c}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(batch.num_rows, -1) for i in (2, 3))
            ok = pa.array((x == y).sum(axis=1) >= floor)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    joined = pairs.join(sig("b"), "b").join(sig("a"), "a").select("a", "b", "sig_a", "sig_b")
    return joined.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole shingle sets are similar enough. Only texts in pairs are read into the joins."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # Written first: the optimizer then knows its size, and moves all texts only where it is too large to broadcast.
    wanted = cut(wanted, "near-wanted")
    texts = cut(docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id"), "near-texts")
    release(wanted)
    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))

    def run(batches):
        shingler, last, left = Shingler(words), None, None
        for batch in batches:
            a, b = [], []
            for ida, idb, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None or ta != last:
                    last, left = ta, shingler.codes(ta)
                right = shingler.codes(tb)
                if similar(left, right, percent):
                    a.append(ida)
                    b.append(idb)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


class Block:
    """Rows of a group: ids, components, signatures, and their shingle codes one after another (none for a bucket)."""

    def __init__(self, ids, component, signature, codes, sizes):
        self.arrays = ids, component, signature, codes, sizes
        self.ids, self.component, self.signature, self.codes, self.sizes = self.arrays
        self.ends = np.cumsum(sizes)
        self._postings = None

    def __len__(self):
        return len(self.ids)

    def dump(self) -> bytes:
        data = io.BytesIO()
        for values in self.arrays:
            np.save(data, values)
        return data.getvalue()

    @classmethod
    def load(cls, uri: str) -> "Block | None":
        """None for a block that no row fell into."""
        fs, path = store(uri)
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_file(path) as f:
            data = io.BytesIO(f.read())
        return cls(*(np.load(data) for _ in range(5)))

    def set_of(self, i: int) -> np.ndarray:
        return self.codes[self.ends[i] - self.sizes[i] : self.ends[i]]

    def shared(self, codes: np.ndarray) -> np.ndarray:
        """How many of the distinct ``codes`` each row holds."""
        if self._postings is None:
            order = np.argsort(self.codes, kind="stable")
            self._postings = self.codes[order], np.repeat(np.arange(len(self)), self.sizes)[order]
        sorted_, owner = self._postings
        out = np.zeros(len(self), np.int64)
        for start in range(0, len(codes), 4096):
            part = codes[start : start + 4096]
            first = np.searchsorted(sorted_, part, "left")
            n = np.searchsorted(sorted_, part, "right") - first
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out += np.bincount(owner[at], minlength=len(self))
        return out


def _likely(left: Block, i: int, right: Block, itself: bool, floor: int) -> np.ndarray:
    """The places of ``right`` that row ``i`` of ``left`` agrees with often enough, in other components."""
    js = np.flatnonzero(right.component != left.component[i])
    js = js[js > i] if itself else js
    return js[(right.signature[js] == left.signature[i]).sum(axis=1) >= floor]


def _connecting(left: Block, other: Block | None, floor: int):
    """Edges that connect what the likely pairs of two blocks (or of one) connect; a row sends one at most."""
    right, shift = other or left, len(left) if other else 0
    pairs = [(i, _likely(left, i, right, other is None, floor)) for i in range(len(left))]
    i = np.concatenate([np.full(len(js), i) for i, js in pairs])
    j = np.concatenate([js for _, js in pairs]) + shift
    ids = np.concatenate([left.ids, right.ids]) if other else left.ids
    labels = smallest_labels(ids.copy(), i, j)
    at = labels != ids
    return ids[at], labels[at]


def _joining(left: Block, other: Block | None, floor: int, percent: int):
    """Confirmed links of two blocks (or of one) that join two of their components."""
    right, out = other or left, []
    names, place = np.unique(np.concatenate([left.component, right.component]), return_inverse=True)
    of_left, of_right = place[: len(left)], place[len(left) :]
    root = np.arange(len(names))
    for i in range(len(left)):
        js = _likely(left, i, right, other is None, floor)
        js = js[root[of_right[js]] != root[of_left[i]]]
        if not len(js):
            continue
        codes = left.set_of(i)
        both = right.shared(codes)[js]
        for j in js[(both > 0) & (100 * both >= percent * (len(codes) + right.sizes[js] - both))]:
            a, b = root[of_left[i]], root[of_right[j]]
            if a != b:
                root[root == b] = a
                out.append((left.ids[i], right.ids[j]))
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def _compared(rows: DataFrame, group: str, each, words: int | None = None) -> DataFrame:
    """(a, b): what ``each`` finds in every block of a group and in every two of them. ``rows`` holds the group, id,
    component_id and signature, with ``words`` also text. Blocks of groups with several are written to the shared folder."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "near-blocks")
    sizes = cut(rows.groupBy(group).agg((F.floor(F.count("*") / BLOCK) + 1).alias("n_blocks")), "group-sizes")
    laid = rows.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")))
    laid = laid.select(group, "block", "n_blocks", "id", "component_id", "signature", *(["text"] if words else []))
    laid = laid.repartition(n, group, "block").sortWithinPartitions(group, "block")
    name = lambda g, block: f"{g}_{block}.npy"

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found], ["a", "b"])

    def alone(batches):
        shingler = Shingler(words) if words else None
        for run in sorted_runs(batches, 2):
            several = run.column(2)[0].as_py() > 1
            if run.num_rows < 2 and not several:
                continue
            sig = np.frombuffer(b"".join(run.column(5).to_pylist()), "<u4").reshape(run.num_rows, -1)
            codes = [shingler.codes(t.as_py()) for t in run.column(6)] if words else [np.empty(0, np.uint64)] * run.num_rows
            block = Block(run.column(3).to_numpy(), run.column(4).to_numpy(), sig, np.concatenate(codes), np.array([len(c) for c in codes]))
            if several:
                publish(folder, name(run.column(0)[0].as_py(), run.column(1)[0].as_py()), block.dump())
            yield batch(each(block, None))

    def together(batches):
        for b in batches:
            for g, m, a, part in zip(*(c.to_pylist() for c in b.columns)):
                left = Block.load(f"{folder}/{name(g, a)}")
                if left is None:
                    continue
                # Block a meets those that come after it in half of a ring.
                for step in range(part * MEETINGS + 1, min((part + 1) * MEETINGS, m // 2) + 1):
                    other = Block.load(f"{folder}/{name(g, (a + step) % m)}") if 2 * step < m or a < step else None
                    if other:
                        yield batch(each(left, other))

    inside = cut(laid.mapInArrow(alone, "a long, b long"), "near-inside")
    units = sizes.where("n_blocks > 1").select(F.col(group), "n_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("a"))
    parts = F.sequence(F.lit(0).cast("long"), F.ceil(F.floor(F.col("n_blocks") / 2) / MEETINGS) - 1)
    units = units.select("*", F.explode(parts).alias("part")).repartition(n, group, "a", "part")
    found = cut(inside.unionByName(units.mapInArrow(together, "a long, b long")).distinct(), "near-found")
    release(sizes, inside)
    discard(spark, folder)
    return found


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, hashes: int = HASHES) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id), kept (it is that document) per row of ``docs``."""
    floor = hashes * percent // 100 - SLACK
    signed = cut(signatures(docs, words, hashes), "signatures")
    usable = signed.where("set_key is not null and doc_id is not null")
    classes = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "signature")).alias("m"))
    classes = cut(classes.select("set_key", F.col("m.doc_id").alias("id"), F.col("m.signature").alias("signature")), "classes")

    buckets = cut(_bands(classes, hashes), "buckets")
    shared = cut(buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("bucket", "a"), "leaders")
    members = cut(buckets.join(shared, "bucket"), "members")
    release(buckets, shared)
    stars = members.where("a <> id").select("a", F.col("id").alias("b")).distinct()
    stars = cut(_agreeing(stars, classes, floor), "stars")
    links = cut(_confirmed(stars, docs, words, percent), "links")
    release(stars)

    found = cut(components(links), "components")
    labelled = members.join(found, "id", "left").select("bucket", "id", F.coalesce("component_id", "id").alias("component_id"))
    labelled = cut(labelled, "labelled")
    release(members)
    mixed = labelled.groupBy("bucket").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo <> hi")
    open_ = labelled.join(mixed.select("bucket"), "bucket").join(classes.select("id", "signature"), "id")
    connected = _compared(open_, "bucket", lambda left, other: _connecting(left, other, floor))
    family = cut(components(connected), "families")
    release(connected)
    if not family.isEmpty():
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(family.withColumnRenamed("component_id", "family"), "id")
        parts = labelled.select("id", "component_id").distinct().join(texts, "id").join(classes.select("id", "signature"), "id")
        across = _compared(parts, "family", lambda left, other: _joining(left, other, floor, percent), words)
        found = cut(components(cut(links.unionByName(across), "links")), "components")
    release(labelled, family)

    # A row takes the component of its set.
    names = classes.join(found, "id", "left").select("set_key", F.coalesce("component_id", "id").alias("component_id"))
    rows = signed.select("doc_id", "n_shingles", "set_key").join(names, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a smaller doc_id of their group stands for."""
    gone = near_duplicates(docs, words, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
