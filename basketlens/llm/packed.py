"""Token ids in files of patched frame-of-reference blocks.

A block holds up to ``BLOCK`` ids: each minus the block's minimum, packed with the number of bits that a percentile of
them needs; the others are exceptions, a list of positions and high bits. A file is a header, the blocks, and an index
of the blocks' places, so that any range of ids is read without the blocks before it. A sidecar table gives each
document's first id and number of ids.

Files follow the order of doc_id. Tasks that write at the same time do not know where they start; the table of files,
with one row for each, gives the ids before a file.

Defined cases: NULL and empty text has the end id only; documents with NULL doc_id come last; repeated rows are
documents of their own; an empty table gives no files; other columns are ignored.
"""

import functools
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import cut, extended, publish, shared_folder, store

BLOCK = 4096
PERCENTILE = 0.95
FILE_IDS = 8 << 20
END_ID = 2
MAGIC = b"PFOR0001"


# ---- blocks ----


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """minimum, count, width, number of exceptions | packed bits | exception positions | exception high parts."""
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    place = min(len(rest) - 1, int(np.ceil(percentile * len(rest))) - 1)
    width = int(np.partition(rest, place)[place]).bit_length()
    at = np.flatnonzero(rest >> np.uint32(width) if width < 32 else np.zeros(0))
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    high = (rest[at] >> np.uint32(width)).astype("<u4")
    return struct.pack("<IIBI", low, len(ids), width, len(at)) + packed + at.astype("<u2").tobytes() + high.tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    low, n, width, outliers = struct.unpack_from("<IIBI", data)
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, 13), count=n * width, bitorder="little").reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits
    ids = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()
    if outliers:
        at = np.frombuffer(data, "<u2", outliers, 13 + size)
        ids[at] |= np.frombuffer(data, "<u4", outliers, 13 + size + 2 * outliers) << np.uint32(width)
    return ids + np.uint32(low)


def pack_file(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """magic, ids, ids per block, index place | blocks | start of every block and end of the last."""
    blocks = [pack_block(ids[i : i + block]) for i in range(0, len(ids), block)]
    starts = np.cumsum([28, *map(len, blocks)]).astype("<u8")
    return MAGIC + struct.pack("<QIQ", len(ids), block, int(starts[-1])) + b"".join(blocks) + starts.tobytes()


class IdFile:
    """Random access to the ids of a file. ``read_at(length, offset)`` gives bytes of it."""

    def __init__(self, read_at):
        self.read_at = read_at
        head = read_at(28, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        self.n, self.block, place = struct.unpack_from("<QIQ", head, 8)
        count = -(-self.n // self.block)
        self.starts = np.frombuffer(read_at(8 * (count + 1), place), "<u8")
        self.last = (-1, None)  # neighbouring documents share a block

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start``, from the blocks that hold them."""
        if not n:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        got = [self.last[1]] if self.last[0] == first else []
        if (begin := first + len(got)) <= last:
            lo, hi = int(self.starts[begin]), int(self.starts[last + 1])
            data = self.read_at(hi - lo, lo)
            cuts = self.starts[begin : last + 2].astype(np.int64) - lo
            got += [unpack_block(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.last = (last, got[-1])
        got = np.concatenate(got)
        return got[start - first * self.block :][:n]


# ---- tokens ----


class ByteBpe:
    """Byte-level BPE of a tokenizer file. The merges run in a rank table library, which is several times faster than
    the one that reads such files and gives the same ids. Its arrays are taken as they are; a memo of words in Python costs three times as much."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, spec: str):
        t = tokenizers.Tokenizer.from_str(spec)
        self.added = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
        chars = _byte_chars()
        ranks = {bytes(chars[c] for c in token): i for token, i in t.get_vocab(with_added_tokens=False).items() if i not in self.added.values()}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=self.added)
        self.special = set(self.added)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return self.encoding.encode_to_numpy(text, allowed_special=self.special).astype("<u4").tobytes()


@functools.lru_cache(maxsize=1)
def _byte_bpe(spec):
    """One encoder per worker process: the vocabulary takes a second to load."""
    return ByteBpe(spec)


def _byte_chars():
    """The byte that each character of a byte-level vocabulary stands for."""
    from basketlens.llm.bpe import BYTE_CHARS

    return {c: b for b, c in BYTE_CHARS.items()}


# ---- files ----


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents in doc_id order; (part, file, path, doc_id, offset, n_tokens) per document.

    ``part`` and ``file`` order the files, ``offset`` is a document's place in its file."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # as large as the vocabulary

    def run(batches):
        bpe, ids, rows, size, file = _byte_bpe(spec.value), [], [], 0, 0
        tail = struct.pack("<I", end_id)
        part = None

        def close():
            path = publish(folder, f"{uuid.uuid4().hex}.ids", pack_file(np.frombuffer(b"".join(ids), "<u4")))
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([file] * n, pa.int32()), pa.array([path] * n, pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                ["part", "file", "path", "doc_id", "offset", "n_tokens"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, text, part = (batch.column(i)[row].as_py() for i in range(3))
                data = bpe.encode(text or "") + tail
                ids.append(data)
                rows.append((doc_id, size, len(data) // 4))
                size += len(data) // 4
                if size >= file_ids:
                    yield close()
                    ids, rows, size, file = [], [], 0, file + 1
        if rows:
            yield close()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last()]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("part", F.spark_partition_id())
    return cut(ordered.mapInArrow(run, "part int, file int, path string, doc_id long, offset long, n_tokens long"), "id-index")


def placed(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: the ids of all documents before, over all files."""
    files = index.groupBy("part", "file", "path").agg(F.sum("n_tokens").alias("n"))  # one row per file
    files = files.withColumn("before", F.sum("n").over(Window.orderBy("part", "file")) - F.col("n"))
    return index.join(files.select("path", "before"), "path").withColumn("start", F.col("before") + F.col("offset")).drop("before")


def read_ids(index: DataFrame) -> DataFrame:
    """``index`` with ``ids_crc32``, the unsigned CRC-32 of each document's ids as read back from its file."""
    names = index.columns
    path, offset, count = (names.index(c) for c in ("path", "offset", "n_tokens"))

    def run(batches):
        opened, file = None, None
        for batch in batches:
            codes = []
            for p, o, n in zip(*(batch.column(i).to_pylist() for i in (path, offset, count))):
                if p != opened:
                    fs, at = store(p)
                    source = fs.open_input_file(at)
                    opened, file = p, IdFile(source.read_at)
                codes.append(zlib.crc32(file.ids(o, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], [*names, "ids_crc32"])

    index = index.sortWithinPartitions("path", "offset")
    return index.mapInArrow(run, extended(index, ids_crc32="long"))


def packed_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files."""
    index = write_ids(docs, tokenizer, shared_folder(docs.sparkSession, "ids"))
    return read_ids(placed(index)).select("doc_id", "start", "n_tokens", "ids_crc32")
