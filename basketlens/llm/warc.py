"""WARC archives: writing, normalising monolithic gzip files, and reading by their sidecars.

Writers often compress a whole archive as one gzip stream, which can only be read from its start. The normaliser
inflates such a file once, as a stream, writes every record as a gzip member of its own, and a sidecar that gives
each record's offset and length. Records are then read in any order and by any number of tasks.

Every task writes files of bounded size under new names, so an attempt that is repeated leaves no half file, and only
the files that the successful attempts report are used. A task deletes nothing: the monolithic files go when all
archives are written. An archive and its sidecar are all that a reader needs.

Defined cases: NULL html is an empty payload; a row whose page_id is NULL is written with an empty page id and
comes last among equal payloads; repeated rows are records of their own, and refer to the first page id; NULL
urls are written as urn:page; an empty table gives no archives; other columns are ignored.
"""

import base64
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import cut, discard, publish, shared_folder, store

# Payload bytes of one monolithic file.
FILE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 0
CHUNK = 1 << 20
# Bytes of an archive that are read as one unit, and units (monolithic files, ranges of archives) of one task where there are many.
READ_BYTES = 16 << 20
FILES_OF_TASK = 4
RANGES_OF_TASK = 8
ARCHIVE, SIDECAR = ".warc.gz", ".idx"
# Fixed values of the format.
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record. A revisit has headers only."""
    name = "" if page_id is None else str(page_id)
    uri = "".join((url or f"urn:page:{name}").split()) or f"urn:page:{name}"
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {uri}')}>",
        f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"X-Page-Id: {name}", f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {'' if refers_to is None else refers_to}"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict, bytes]:
    """(headers, block) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def decided(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, refers_to, is_revisit. Of equal payloads, the smallest page_id is the response."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Digests are grouped apart from the payloads, with partial minima: a frequent payload is no hot group.
    first = rows.select("digest", "page_id").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = cut(first.select("digest", "first"), "warc-first")
    rows = rows.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & (F.length("payload") >= min_bytes)
    return rows.select("page_id", "url", "payload", F.when(again, F.col("first")).alias("refers_to"), again.alias("is_revisit"))


def write_monolithic(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of ``decided`` as whole-file gzip streams; (path, n_records) per file."""

    def run(batches):
        out, size, n = [], 0, 0
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)

        def close():
            out.append(packer.flush())
            path = publish(folder, f"{uuid.uuid4().hex}{ARCHIVE}", b"".join(out))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])

        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page_id, url, payload, refers_to, revisit)
                out.append(packer.compress(data))
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield close()
                    out, size, n, packer = [], 0, 0, zlib.compressobj(6, zlib.DEFLATED, 31)
        if n:
            yield close()

    return cut(rows.mapInArrow(run, "path string, n_records long"), "warc-files")


def split_records(stream):
    """The records of an uncompressed stream, one at a time."""
    kept = b""
    while True:
        while (at := kept.find(b"\r\n\r\n")) < 0:
            more = stream.read(CHUNK)
            if not more:
                if kept.strip():
                    raise ValueError("the archive ends inside a record")
                return
            kept += more
        length = next(int(x[15:]) for x in kept[:at].split(b"\r\n") if x[:15].lower() == b"content-length:")
        size = at + 4 + length + 4
        parts, have = [kept], len(kept)
        while have < size:
            more = stream.read(max(CHUNK, size - have))
            if not more:
                raise ValueError("the archive ends inside a record")
            parts.append(more)
            have += len(more)
        kept = b"".join(parts)
        yield kept[:size]
        kept = kept[size:]


class Inflated(io.RawIOBase):
    """A gzip file of one or more members as a stream, inflated in pieces."""

    def __init__(self, source):
        self.source, self.packer, self.begun = source, zlib.decompressobj(31), False

    def read(self, size=-1):
        while True:
            if self.packer.eof:
                left, self.packer, self.begun = self.packer.unused_data, zlib.decompressobj(31), False
            else:
                left = self.packer.unconsumed_tail
            data = left or self.source.read(CHUNK)
            if not data and not self.begun:
                return b""
            self.begun = True
            out = self.packer.decompress(data, max(size, 1))
            if out:
                return out
            if not data and not self.packer.eof:
                raise ValueError("the gzip stream is cut off")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file of ``files`` with a gzip member per record and a sidecar beside it; (path, n_records, bytes) per file."""

    def run(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                fs, path = store(source)
                members, offsets, at = [], [], 0
                with fs.open_input_stream(path, compression=None) as raw:  # inflated here, record by record
                    for data in split_records(Inflated(raw)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        members.append(packer.compress(data) + packer.flush())
                        offsets.append((at, len(members[-1])))
                        at += len(members[-1])
                name = uuid.uuid4().hex
                # The sidecar first: an archive that is there can be read.
                publish(folder, f"{name}{SIDECAR}", "".join(f"{o} {n}\n" for o, n in offsets).encode())
                target = publish(folder, f"{name}{ARCHIVE}", b"".join(members))
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([len(offsets)], pa.int64()), pa.array([at], pa.int64())], ["path", "n_records", "bytes"])

    return cut(_dealt(files.select("path"), FILES_OF_TASK).mapInArrow(run, "path string, n_records long, bytes long"), "warc-archives")


def _dealt(units: DataFrame, per_task: int) -> DataFrame:
    """Units of work, dealt out evenly: a lost task repeats ``per_task`` of them, or one where there are few."""
    n = units.count()
    return units.repartition(max(1, min(n, max(units.sparkSession.sparkContext.defaultParallelism, -(-n // per_task)))))


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives in a folder; nothing of their content is read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{ARCHIVE}").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def sidecar(path: str) -> list[tuple[int, int]]:
    """(offset, length) of the records of an archive, from the sidecar beside it."""
    fs, at = store(path.removesuffix(ARCHIVE) + SIDECAR)
    with fs.open_input_stream(at, compression=None) as f:
        return [tuple(map(int, line.split())) for line in f.read().splitlines()]


def read_records(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and content of the records of ``archives`` (path,
    bytes). Offsets come from the sidecars; an archive of more than ``READ_BYTES`` is read in ranges of them."""
    parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("bytes") / READ_BYTES) - 1, F.lit(0)))
    units = _dealt(archives.select("path", F.explode(parts).alias("part")), RANGES_OF_TASK)

    def run(batches):
        for batch in batches:
            for path, part in zip(*(c.to_pylist() for c in batch.columns)):
                fs, at = store(path)
                rows, held = [], 0
                with fs.open_input_file(at) as handle:
                    for offset, length in sidecar(path):
                        if offset // READ_BYTES != part:
                            continue
                        headers, block = parse(zlib.decompress(handle.read_at(length, offset), 31))
                        revisit = headers["WARC-Type"] == "revisit"
                        content = block.partition(b"\r\n\r\n")[2]
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and base32_sha1(content) != digest:
                            raise ValueError(f"{path} at {offset}: the payload does not have its digest")
                        number = lambda x: int(x) if x else None
                        rows.append((number(headers["X-Page-Id"]), int(headers["X-Payload-Length"]), digest, headers["WARC-Type"], number(headers.get("X-Refers-To-Page")), content))
                        held += len(content)
                        if len(rows) >= 256 or held >= READ_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, content binary"
    return units.mapInArrow(run, schema)


def _batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "content"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def archive(pages: DataFrame) -> DataFrame:
    """(path, n_records, bytes) of normalised archives of all pages."""
    spark = pages.sparkSession
    raw = shared_folder(spark, "warc-raw")
    files = write_monolithic(decided(pages), raw)
    found = normalise(files, shared_folder(spark, "warc"))
    discard(spark, raw)
    return found


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages' records as they come back from the normalised archives."""
    return read_records(archive(pages)).drop("content")
