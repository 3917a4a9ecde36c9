"""BPE encoding with a minimal acyclic transducer of frequent words, and decoding.

Words are counted over all documents. The frequent ones are compiled, with their token ids, into an
acyclic automaton whose equal suffixes are shared; it is written to one file, sent to the executors by
Spark and memory-mapped there. A word outside the lexicon is merged step by step by the rank table.

Defined cases: NULL and empty text have no tokens; the strings of the added tokens become their ids
wherever they stand; repeated rows are encoded each on its own; other columns pass through untouched.
"""

import functools
import itertools
import json
import mmap
import struct
import unicodedata
import uuid
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import extended, publish, shared_folder

LEXICON_WORDS = 100_000
MIN_COUNT = 2
# Bounds of a worker's memory, not of the work: beyond them a memo starts anew, a counter sends what it has.
MEMO_ENTRIES = 500_000
COUNTER_ENTRIES = 400_000
OUT_BYTES = 8 << 20

_ID_BITS = 24
_ID_MASK = (1 << _ID_BITS) - 1
_NONE = 1 << 62

# Fixed value: the byte alphabet of byte-level vocabularies. Printable bytes stand for themselves, the others
# follow from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class WordBpe:
    """A tokenizer file with lower-casing and word-end symbols: how text splits and how symbols merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.inner = [vocab[BYTE_CHARS[b]] for b in range(256)]
        self.last = [vocab[BYTE_CHARS[b] + suffix] for b in range(256)]
        # A merge is one number: its rank in the upper bits, the new id in the lower ones.
        self.merges = {(vocab[a], vocab[b]): rank << _ID_BITS | vocab[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])}

    def pieces(self, chunk: str) -> list[str]:
        """The words of a text without added tokens, normalised."""
        # One character is lowered at a time, so a sigma at a word's end is no special case.
        text = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return _compiled(self.pattern).findall(text)

    def merge(self, word: str) -> list[int]:
        """Token ids of one word by its merges, lowest rank first, leftmost first."""
        data = word.encode()
        ids = list(map(self.inner.__getitem__, data))
        ids[-1] = self.last[data[-1]]
        return self._merge_long(ids) if len(ids) > 48 else self._merge_short(ids)

    def _merge_short(self, ids):
        get = self.merges.get
        codes = list(map(get, zip(ids, ids[1:]), itertools.repeat(_NONE)))
        while codes and (best := min(codes)) < _NONE:
            i = codes.index(best)
            ids[i] = best & _ID_MASK
            del ids[i + 1], codes[i]
            if i:
                codes[i - 1] = get((ids[i - 1], ids[i]), _NONE)
            if i < len(codes):
                codes[i] = get((ids[i], ids[i + 1]), _NONE)
        return ids

    def _merge_long(self, ids):
        """The same with a heap over a linked list: n log n for words of any length."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(self.merges[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merges]
        heapify(heap)
        while heap:
            code, i, a, b = heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = code & _ID_MASK, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (p := (ids[x], ids[after[x]])) in self.merges:
                    heappush(heap, (self.merges[p], x, *p))
        return [x for x in ids if x >= 0]


@functools.cache
def _compiled(pattern):
    return regex.compile(pattern)


# ---- the lexicon ----


def word_counts(docs: DataFrame, bpe, text: str = "text") -> DataFrame:
    """(word, n) over all documents; every task adds up what it reads before it sends anything."""

    def count(batches):
        model = bpe.value
        special = regex.compile("|".join(map(regex.escape, model.added)))
        for batch in batches:
            chunks, words = Counter(), Counter()

            def fold():
                for chunk, n in chunks.items():
                    for part in special.split(chunk):
                        for w in model.pieces(part):
                            words[w] += n
                chunks.clear()

            for t in batch.column(0):
                chunks.update((t.as_py() or "").replace("\n", " ").split(" "))
                if len(chunks) > COUNTER_ENTRIES:
                    fold()
            fold()
            yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

    return docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int = LEXICON_WORDS, min_count: int = MIN_COUNT) -> list[str]:
    """The words that the lexicon gets: a bounded top list, ties by word. All others are merged when met."""
    top = counts.where((F.col("n") >= min_count) & (F.length("word") <= 64)).orderBy(F.desc("n"), "word").limit(limit)
    return [r["word"] for r in top.select("word").collect()]


def compile_lexicon(words: list[str], encode) -> bytes:
    """The automaton as bytes: words with equal endings share states, and an arc adds the number of words
    that sort before its target, so that a path adds up to the word's place in the table of ids."""
    keys = sorted({w.encode() for w in words if w})
    register, states = {}, []  # states: (final, ((label, target), ...)), children first
    path = [[False, []]]  # the states of the last word, not yet shared

    def close(depth):
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            label = path[-1][1][-1][0]
            path[-1][1][-1] = (label, register[key])

    last = b""
    for key in keys:
        same = next((i for i, (a, b) in enumerate(zip(last, key)) if a != b), min(len(last), len(key)))
        close(same)
        for b in key[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = key
    close(0)
    states.append((path[0][0], tuple(path[0][1])))

    below = []  # words that end at or below a state
    starts, labels, targets, adds = [0], bytearray(), [], []
    for final, arcs in states:
        n = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            adds.append(n)
            n += below[target]
        below.append(n)
        starts.append(len(labels))
    ids = [encode(k.decode()) for k in keys]
    places = np.cumsum([0, *map(len, ids)])
    parts = [
        np.array(starts, "<u4").tobytes(), np.array(targets, "<u4").tobytes(), np.array(adds, "<u4").tobytes(),
        places.astype("<u4").tobytes(), np.array([i for x in ids for i in x], "<u4").tobytes(),
        bytes(int(f) for f, _ in states), bytes(labels),
    ]
    return struct.pack("<7Q", *map(len, parts)) + b"".join(parts)


class Lexicon:
    """A compiled lexicon, memory-mapped. ``find`` gives the ids of a word as little-endian bytes, or None."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes, at = struct.unpack_from("<7Q", self.map), 56
        views = []
        for size in sizes:
            views.append((at, memoryview(self.map)[at : at + size]))
            at += size
        self.starts, self.targets, self.adds, self.places = (v.cast("I") for _, v in views[:4])
        self.ids, self.final, self.labels = views[4][1], views[5][1], views[6][0]
        self.root = len(self.final) - 1
        self.arcs = [None] * len(self.final)  # of the states met so far: label to target and number

    def _open(self, state: int) -> dict:
        first, last = self.starts[state], self.starts[state + 1]
        labels = self.map[self.labels + first : self.labels + last]
        self.arcs[state] = dict(zip(labels, zip(self.targets[first:last], self.adds[first:last])))
        return self.arcs[state]

    def find(self, word: bytes):
        state, place = self.root, 0
        opened = self.arcs
        for b in word:
            arcs = opened[state]
            arc = (self._open(state) if arcs is None else arcs).get(b)
            if arc is None:
                return None
            state = arc[0]
            place += arc[1]
        if not self.final[state]:
            return None
        return bytes(self.ids[4 * self.places[place] : 4 * self.places[place + 1]])


# ---- encoding and decoding ----


class _Memo(dict):
    """Found values by key; a missing one is made. Beyond its bound it starts anew, keys of over 64 characters are not kept."""

    def __init__(self, make, entries):
        self.make, self.entries = make, entries

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Text to ids as little-endian bytes. Chunks between spaces and their words are memoised per worker, within a bound."""

    def __init__(self, model: WordBpe, lexicon: Lexicon | None):
        self.model, self.lexicon = model, lexicon
        self.memo, self.words = _Memo(self.chunk, MEMO_ENTRIES), _Memo(self.word, MEMO_ENTRIES)
        self.special = regex.compile("(" + "|".join(map(regex.escape, model.added)) + ")")

    def word(self, word: str) -> bytes:
        found = self.lexicon.find(word.encode()) if self.lexicon else None
        return struct.pack(f"<{len(ids := self.model.merge(word))}I", *ids) if found is None else found

    def chunk(self, chunk: str) -> bytes:
        if not self.special.search(chunk):
            return b"".join(map(self.words.__getitem__, self.model.pieces(chunk)))
        out = []
        for part in self.special.split(chunk):
            if part in self.model.added:
                out.append(struct.pack("<I", self.model.added[part]))
            elif part:
                out.extend(map(self.words.__getitem__, self.model.pieces(part)))
        return b"".join(out)

    def text(self, text: str) -> bytes:
        # No word holds white space, so spaces and line ends may part the text before anything else.
        return b"".join(map(self.memo.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name, model):
    """One encoder per worker process and lexicon."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(model, Lexicon(SparkFiles.get(name)))
    return _ENCODERS[name]


def encode(docs: DataFrame, tokenizer: str, text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with ``ids`` (binary: token ids as little-endian unsigned 32-bit numbers) and ``decoded``
    (the string that the ids decode to). ``docs`` is read twice: for the word counts and for the encoding."""
    spark = docs.sparkSession
    model = WordBpe(tokenizer)
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary file
    words = frequent_words(word_counts(docs, shared, text), lexicon_words)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(publish(shared_folder(spark, "lexicon"), name, compile_lexicon(words, model.merge)))
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    at = keep.index(text)

    def run(batches):
        encoder = _encoder(name, shared.value)
        get = shared.value.tokens.__getitem__
        for batch in batches:
            start, size, ids, decoded = 0, 0, [], []
            for row in range(batch.num_rows):
                data = encoder.text(batch.column(at)[row].as_py() or "")
                ids.append(data)
                decoded.append(" ".join(map(get, np.frombuffer(data, "<u4").tolist())))
                size += len(data) + len(decoded[-1])
                if size > OUT_BYTES or row + 1 == batch.num_rows:
                    part = batch.slice(start, row + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], [*keep, "ids", "decoded"])
                    start, size, ids, decoded = row + 1, 0, [], []

    plain = docs.select(*keep)
    return plain.mapInArrow(run, extended(plain, ids="binary", decoded="string"))


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the encoded documents."""
    coded = encode(docs.select("doc_id", "text"), tokenizer)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
