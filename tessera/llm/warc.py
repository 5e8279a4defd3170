"""WARC archives: writing, normalising whole-file gzip, and reading.

``write_archives`` writes pages as WARC records into monolithic gzip files (one
stream around all records of a file), as many crawlers leave them. Records with
equal payloads of at least ``least`` bytes are written once as response; the others
become revisit records that refer to it. ``normalise`` inflates each such stream
once through Spark's line reader, whatever the size of the file, holding one record and one batch of lines
at a time, and writes every record as a gzip member of its own, together with a sidecar index of
(offset, length) per record. Past ``most_bytes`` of members an archive goes on in the next, NAME-00001.warc.gz,
so that each can be read as one value.
``read_archives`` and ``read_index`` read the results.

Files go through Spark's text writer, so they land in any store Spark can write and
are committed like all its output. The writer ends every row with a separator; the
rows here leave out exactly that: in monolithic files the CR LF CR LF that ends a
record, in members the zero byte that ends the gzip trailer of a record under 16 MiB
(a larger one gets an empty member, which ends in zeros, behind it). The files are
plain WARC and gzip, byte for byte. An archive is a folder
``archive=NAME.warc.gz`` with the file in ``kind=warc`` and its index (gzip, one
``offset length record-id type`` line per record) in ``kind=index``.

A gzip stream can't be split: one task reads one file, so the writer starts a new
archive every ``archive_bytes`` of records. A truncated or malformed archive raises. A very long payload is held
whole, once. Of equal payloads ties go to the smallest page_id.

Nulls: null html is an empty payload, null url is ``urn:page:ID``, a null page_id is
left out of the record. Repeated rows: rows equal in page_id and payload to a response are
responses too. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import join_slim, map_arrow, materialize, new_path

END = b"\r\n\r\n"
#: Compressed bytes given to zlib at once where members are short.
STEP = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_OUT = "archive string, kind string, data binary"
_RECORDS = "archive string, seq long, offset long, length long, page_id long, record_id string, record_type string, uri string, payload_bytes long, payload_digest string, refers_to_id string, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}|{digest}'.encode()).digest()[:16], version=4)}>"


def _build(page_id: int | None, url: str | None, payload: bytes, digest: str, owner: int | None, date: str) -> bytes:
    """A whole record without the CR LF CR LF behind it."""
    revisit = owner is not None and owner != page_id
    uri = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(owner, digest)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block


def _out(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.binary()), strict=True)], names=["archive", "kind", "data"])


def _grouped(rows: Iterator[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= most or len(held) >= 5000:
            yield _out(held)
            held, size = [], 0
    if held:
        yield _out(held)


def _records(date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, written = TaskContext.get().partitionId(), 0

        def rows() -> Iterator[tuple]:
            nonlocal written
            for batch in batches:
                for page_id, url, html, digest, owner in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                    data = _build(page_id, url, (html.as_py() or "").encode("utf-8", "surrogatepass"), digest, owner, date)
                    yield f"{part:06d}-{written // archive_bytes:06d}.warc.gz", "warc", data
                    written += len(data)

        yield from _grouped(rows())

    return run


def write_archives(pages: DataFrame, path: str, least: int = 100, archive_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes pages as monolithic gzip WARC files under path."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    first = slim.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("owner"), F.count("*").alias("n"))
    first = materialize(first.filter("n > 1").select("digest", "owner"), "payloads")
    joined = join_slim(slim, first, ["digest"], "left").select("page_id", "url", "html", "digest", "owner")
    rows = joined.transform(map_arrow, _records(date, archive_bytes), _OUT).drop("kind")
    rows.withColumn("data", F.col("data").cast("string")).write.partitionBy("archive").option("compression", "gzip").option("lineSep", END.decode()).text(path)


class Cutter:
    """Cuts a stream of inflated bytes into records, without the CR LF CR LF behind each; holds one record and what was fed last."""

    def __init__(self):
        self.held, self.need = bytearray(), None

    def feed(self, data) -> Iterator[bytes]:
        held = self.held
        held += data
        while True:
            if self.need is None:
                end = held.find(END)
                if end < 0:
                    return
                self.need = end + 4 + int(header(bytes(held[:end]), b"content-length") or -1)
                if self.need < end + 4:
                    raise ValueError("record without a content length")
            if len(held) < self.need + 4:
                return
            if held[self.need : self.need + 4] != END:
                raise ValueError("record doesn't end where its length says")
            yield bytes(held[: self.need])
            del held[: self.need + 4]
            self.need = None

    def end(self) -> None:
        if self.held.strip():
            raise ValueError("truncated record")


def header(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip()
    return None


def member(data: bytes, level: int = 6) -> bytes:
    """data as gzip whose last byte is zero: one member, or, from 16 MiB on, one and an empty one."""
    out = gzip.compress(data, level, mtime=0)
    return out if out[-1] == 0 else out + gzip.compress(b"", mtime=0)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, memoryview]]:
    """(file, bytes) for each stretch of a batch's lines that is of one file; a line feed ends every line."""
    names, lines, at = pc.run_end_encode(batch.column(0)), batch.column(1), 0
    for name, end in zip(names.values.to_pylist(), names.run_ends.to_pylist(), strict=True):
        some = pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), lines.slice(at, end - at))
        yield name, memoryview(pc.binary_join(some, b"\n")[0].as_buffer())
        yield name, memoryview(b"\n")
        at = end


def _normalised(level: int, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            path, cutter, part, at, lines = None, None, 0, 0, []

            def name() -> str:
                base = path.rstrip("/").split("/archive=")[-1].split("/")[0] if "/archive=" in path else path.split("/")[-1]
                return base if not part else f"{base.removesuffix('.gz').removesuffix('.warc')}-{part:05d}.warc.gz"

            def index() -> tuple:
                return name(), "index", member(b"".join(lines))[:-1]

            for batch in batches:
                for file, data in _runs(batch):
                    if file != path:
                        if cutter is not None:
                            cutter.end()
                            yield index()
                        path, cutter, part, at, lines = file, Cutter(), 0, 0, []
                    for record in cutter.feed(data):
                        if at >= most_bytes:
                            yield index()
                            part, at, lines = part + 1, 0, []
                        head = record[: record.find(END)]
                        out = member(record + END, level)
                        lines.append(b"%d %d %s %s\n" % (at, len(out), header(head, b"warc-record-id") or b"-", header(head, b"warc-type") or b"-"))
                        at += len(out)
                        yield name(), "warc", out[:-1]
            if cutter is not None:
                cutter.end()
                yield index()

        yield from _grouped(rows())

    return run


def normalise(spark: SparkSession, path: str, out: str, pattern: str = "*.gz", level: int = 6, most_bytes: int = 256 << 20) -> None:
    """Rewrites the whole-file gzip WARC files under path as one member per record, with sidecar indexes."""
    # The reader inflates by the file's name and hands bytes on as they are; a file is one task's, from its first line to its last.
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    rows = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("line")).transform(map_arrow, _normalised(level, most_bytes), _OUT)
    rows.withColumn("data", F.col("data").cast("string")).write.partitionBy("archive", "kind").option("lineSep", "\0").text(out)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _RECORDS.split(", ")]

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name, data, at, seq = path.split("/archive=")[-1].split("/")[0], memoryview(content.as_buffer()), 0, 0
                while at < len(data):
                    inflater, parts, length = zlib.decompressobj(31), [], 0
                    while not inflater.eof:  # in steps: zlib copies what it is given beyond the member
                        piece = data[at + length : at + length + STEP]
                        if not piece:
                            raise ValueError(f"truncated member in {path}")
                        parts.append(inflater.decompress(piece))
                        length += len(piece) - len(inflater.unused_data)
                    record = b"".join(parts)
                    if record:
                        yield (name, seq, at, length, *parse(record))
                        seq += 1
                    at += length

    held, size = [], 0
    for row in rows():
        held.append(row)
        size += len(row[-1])
        if size > 8 << 20 or len(held) >= 5000:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def parse(record: bytes) -> tuple:
    """page_id, record id, type, uri, payload bytes and digest (of the full payload, also for revisits), refers-to id, payload."""
    end = record.find(END)
    head = record[:end]
    get = lambda name: (header(head, name) or b"").decode() or None
    block = record[end + 4 : end + 4 + int(get(b"content-length"))]
    http, _, payload = block.partition(END)
    kind = get(b"warc-type")
    if kind == "revisit":
        size, digest = int(header(http, b"content-length") or 0), (get(b"warc-payload-digest") or "").removeprefix("sha256:")
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    page = get(b"warc-page-id")
    return (int(page) if page else None, get(b"warc-record-id"), kind, get(b"warc-target-uri"), size, digest, get(b"warc-refers-to"), payload)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of normalised archives; payload is empty for revisits."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.col("path").contains("/kind=warc/"))
    return files.select("path", "content").transform(map_arrow, _parsed, _RECORDS)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes: archive, seq, offset, length, record_id, record_type."""

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines = [x.split(b" ") for x in gzip.decompress(content.as_py()).splitlines()]
                if lines:
                    a, b, c, d = zip(*lines, strict=True)
                    yield pa.record_batch([pa.array([name.split("/archive=")[-1].split("/")[0]] * len(a)), pa.array(range(len(a)), pa.int64()), pa.array(map(int, a), pa.int64()), pa.array(map(int, b), pa.int64()), pa.array([x.decode() for x in c]), pa.array([x.decode() for x in d])], names=["archive", "seq", "offset", "length", "record_id", "record_type"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter(F.col("path").contains("/kind=index/"))
    return files.select("path", "content").transform(map_arrow, run, "archive string, seq long, offset long, length long, record_id string, record_type string")


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Writes, normalises and reads back: page_id, payload_bytes, payload_digest,
    record_type, refers_to, archive, offset, length."""
    spark = pages.sparkSession
    raw, out = new_path(spark, "warc"), new_path(spark, "members")
    write_archives(pages, raw, least)
    normalise(spark, raw, out)
    records = materialize(read_archives(spark, out).drop("payload", "uri", "seq"), "records")
    owners = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).dropDuplicates(["refers_to_id"])
    wanted = materialize(owners.join(records.filter("record_type = 'revisit'").select("refers_to_id").distinct(), "refers_to_id", "left_semi"), "owners")
    return join_slim(records, wanted, ["refers_to_id"], "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length")
