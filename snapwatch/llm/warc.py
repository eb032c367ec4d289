"""WARC archives: monolithic gzip files, their rewriting with a gzip member per record and an offset index, reading back."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwatch.llm.tables import Tables

# An archive is closed after about so many bytes before compression: it is what one task rewrites or reads.
ARCHIVE_BYTES = 64 << 20
LEVEL = 1
CHUNK = 1 << 18
# Rewriting and reading are dealt to at most so many tasks.
MOST_TASKS = 10_000
# Rows of so many bytes are handed over at a time.
BATCH_BYTES = 16 << 20

# The format's version, end of lines, media types and the profile of revisits; a date for pages without one.
VERSION = b"WARC/1.1"
END = b"\r\n"
RESPONSE_TYPE = "application/http; msgtype=response"
INFO_TYPE = "application/warc-fields"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"

Header = dict[str, str]

RECORDS = "archive string, number long, record_id string, page_id long, payload_digest string, payload_bytes long"
NORMAL = "archive string, sidecar string, records long, bytes long"
READ = (
    "page_id long, url string, record_type string, record_id string, refers_to_id string, refers_to long, "
    "payload_bytes long, payload_digest string, archive string, offset long, length long, payload binary"
)


def payload_digest(payload: bytes) -> str:
    return _base32(hashlib.sha1(payload))


def _base32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def record_head(fields: Header) -> bytes:
    """A record's header with its empty line. Characters that would break a line are percent-encoded."""
    line = lambda value: re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)
    lines = [f"{name}: {line(value)}".encode() for name, value in fields.items()]
    return END.join([VERSION, *lines, b"", b""])


def _parsed(head: bytes) -> Header:
    lines = head.split(END)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:60]!r}")
    return dict(line.decode().split(": ", 1) for line in lines[1:] if line)


def _http_head(length: int) -> bytes:
    return END.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % length, b"", b""])


def _page_of(record_id: str | None) -> int | None:
    found = re.match(r"<urn:page:(-?\d+):", record_id or "")
    return int(found[1]) if found else None


class Inflated:
    """The bytes of a gzip stream of one or many members, inflated once and piece by piece, never as a whole."""

    def __init__(self, chunks: Iterable[bytes]):
        self.chunks, self.inflate, self.held, self.ended = iter(chunks), zlib.decompressobj(31), bytearray(), False
        self.waiting, self.begun = b"", False

    def _more(self) -> bool:
        """Adds some bytes to ``held``; False at the end of the stream."""
        while not self.ended:
            if not self.waiting:
                self.waiting = next(self.chunks, b"")
                if not self.waiting:
                    if self.begun:
                        raise ValueError("the gzip stream is cut off")
                    self.ended = True
                    return False
            self.begun = True
            # Bounded output: a small chunk may inflate to very much.
            out = self.inflate.decompress(self.waiting, CHUNK)
            self.waiting = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.waiting = self.inflate.unused_data
                self.inflate, self.begun = zlib.decompressobj(31), False
            if out:
                self.held += out
                return True
        return False

    def at_end(self) -> bool:
        return not self.held and not self._more()

    def head(self) -> bytes:
        """The lines up to and with the next empty one."""
        seen = 0
        while (at := self.held.find(END * 2, max(0, seen - 3))) < 0:
            seen = len(self.held)
            if not self._more():
                raise ValueError("the archive ends within a header")
        out = bytes(self.held[: at + 4])
        del self.held[: at + 4]
        return out

    def read(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in pieces."""
        while length:
            if not self.held and not self._more():
                raise ValueError("the archive ends within a record")
            piece = bytes(self.held[:length])
            del self.held[:length]
            length -= len(piece)
            yield piece


def _chunks(file, length: int | None = None) -> Iterator[bytes]:
    while (length is None or length > 0) and (piece := file.read(CHUNK if length is None else min(CHUNK, length))):
        length = None if length is None else length - len(piece)
        yield piece


def records_of(stream: Inflated, take: Callable[[Header, Iterator[bytes]], object]) -> Iterator[object]:
    """What ``take`` makes of each record's header and block; a part of the block that it leaves is passed over."""
    while not stream.at_end():
        fields = _parsed(stream.head())
        block = stream.read(int(fields["Content-Length"]))
        yield take(fields, block)
        for _ in block:
            pass
        if b"".join(stream.read(4)) != END * 2:
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is longer than it says")


def _http(block: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The HTTP header of a block, and the payload's pieces."""
    head = b""
    for piece in block:
        head += piece
        if (at := head.find(END * 2)) >= 0:
            rest = head[at + 4 :]
            return head[: at + 4], (p for part in ((rest,), block) for p in part)
    raise ValueError("a response without the end of its HTTP header")


def normalise(chunks: Iterable[bytes], write: Callable[[bytes], object], revisits: dict[int, str]) -> Iterator[dict]:
    """Rewrites a WARC file, read as one stream, with a gzip member for each record; yields the records' index entries.

    ``revisits`` names records by their place in the file: these keep their HTTP header, lose their payload and refer
    to the record id that is given. Payloads are checked against their digests while they pass.
    """
    offset = number = 0

    def take(fields: Header, block: Iterator[bytes]) -> dict:
        nonlocal offset, number
        sha1, size, start = hashlib.sha1(), 0, offset
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)

        def put(piece: bytes) -> None:
            nonlocal offset
            if packed := member.compress(piece):
                write(packed)
                offset += len(packed)

        http, payload = _http(block) if fields["WARC-Type"] == "response" else (b"", block)
        refers_to = revisits.get(number) if fields["WARC-Type"] == "response" else None
        kept = fields
        if refers_to:
            kept = {k: v for k, v in fields.items() if k != "Content-Length"} | {
                "WARC-Type": "revisit",
                "WARC-Profile": SAME_PAYLOAD,
                "WARC-Refers-To": refers_to,
                "Content-Length": str(len(http)),
            }
        put(record_head(kept))
        put(http)
        for piece in payload:
            sha1.update(piece)
            size += len(piece)
            if not refers_to:
                put(piece)
        put(END * 2)
        last = member.flush()
        write(last)
        offset += len(last)
        said = fields.get("WARC-Payload-Digest")
        if http and said and said != f"sha1:{_base32(sha1)}":
            raise ValueError(f"record {fields['WARC-Record-ID']}: its payload is not the one of its digest")
        number += 1
        return {"offset": start, "length": offset - start, "type": kept["WARC-Type"], "id": fields["WARC-Record-ID"], "uri": fields.get("WARC-Target-URI")}

    yield from records_of(Inflated(chunks), take)


def _rows(spark_schema: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about BATCH_BYTES or 10,000 rows."""
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in spark_schema.split(", "))])
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size > BATCH_BYTES or len(held) >= 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Pages (page_id, url, html) as response records in monolithic gzip archives below ``folder``; RECORDS, lazily.

    Where a page is read, there it is written; no page is shuffled. File names hold the number of the attempt, so
    that a task that runs twice leaves a file that no row names.
    """
    most = ARCHIVE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            disk, base = fs.FileSystem.from_uri(folder)
            disk.create_dir(base, recursive=True)
            part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
            archives, file, held = 0, None, 0

            def put(fields: Header, *block: bytes) -> None:
                nonlocal held
                head = record_head(fields | {"Content-Length": str(sum(map(len, block)))})
                for piece in (head, *block, END * 2):
                    held += len(piece)
                    if packed := gzip.compress(piece):
                        file.write(packed)

            def close() -> None:
                file.write(gzip.flush())
                file.close()

            for batch in batches:
                for page, url, html in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"]):
                    payload = html.as_py() or b""
                    if file is None or held >= most:
                        if file:
                            close()
                        name = f"part-{part:05}-{archives:05}-{attempt}.warc.gz"
                        file, gzip = disk.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        archives, held, number = archives + 1, 0, 1
                        put(
                            {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{part}-{archives}>", "WARC-Date": NO_DATE, "Content-Type": INFO_TYPE},
                            b"format: WARC File Format 1.1" + END,
                        )
                    digest = payload_digest(payload)
                    # Unique, and the same when the task runs again.
                    record = f"<urn:page:{'' if page is None else page}:{part}-{archives}-{number}>"
                    fields = {"WARC-Type": "response", "WARC-Record-ID": record, "WARC-Date": NO_DATE}
                    fields |= {} if url is None else {"WARC-Target-URI": url}
                    put(fields | {"WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": RESPONSE_TYPE}, _http_head(len(payload)), payload)
                    yield name, number, record, page, digest, len(payload)
                    number += 1
            if file:
                close()

        yield from _rows(RECORDS, rows())

    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html")
    )
    return chosen.mapInArrow(run, RECORDS)


def revisits_of(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(archive, revisits) of every archive: which of its records repeat a payload, and the record they refer to.

    Of equal payloads of ``least_bytes`` or more, the record of the largest page_id stays (NULL is smaller than any; of
    repeated rows one), whichever archive holds it. The largest is found by combining before the shuffle; what is
    joined to it is narrow, and Spark splits a payload with a great part of the records.
    """
    same = ["payload_digest", "payload_bytes"]
    last = F.max(F.struct("page_id", "archive", "number", "record_id")).alias("last")
    shared = records.where(F.col("payload_bytes") >= least_bytes).groupBy(*same).agg(last, F.count("*").alias("n")).where("n > 1")
    marked = records.join(shared, same, "left")
    itself = (F.col("archive") == F.col("last.archive")) & (F.col("number") == F.col("last.number"))
    repeat = F.when(F.col("last").isNotNull() & ~itself, F.struct("number", F.col("last.record_id").alias("refers_to")))
    # An archive's records are bounded by ARCHIVE_BYTES.
    return marked.groupBy("archive").agg(F.collect_list(repeat).alias("revisits"))


def _dealt(archives: DataFrame) -> DataFrame:
    """One archive is a task's work; their rows are so narrow that adaptive execution would merge all of them."""
    return archives.repartition(min(MOST_TASKS, max(1, archives.count())), "archive")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every archive of (archive, revisits) rewritten, with a sidecar of JSON lines (offset, length, type, id, uri); NORMAL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            disk, base = fs.FileSystem.from_uri(folder)
            attempt = TaskContext.get().taskAttemptId()
            for batch in batches:
                for archive, revisits in zip(batch["archive"].to_pylist(), batch["revisits"].to_pylist()):
                    name = f"{archive.removesuffix('.warc.gz')}-members-{attempt}.warc.gz"
                    sidecar, records, size = f"{name}.index", 0, 0
                    with (
                        disk.open_input_stream(f"{base}/{archive}", compression=None) as source,
                        disk.open_output_stream(f"{base}/{name}", compression=None) as target,
                        disk.open_output_stream(f"{base}/{sidecar}", compression=None) as index,
                    ):
                        for entry in normalise(_chunks(source), target.write, {r["number"]: r["refers_to"] for r in revisits}):
                            index.write(json.dumps(entry).encode() + b"\n")
                            records, size = records + 1, entry["offset"] + entry["length"]
                    yield name, sidecar, records, size

        yield from _rows(NORMAL, rows())

    return archives.mapInArrow(run, NORMAL)


def read_record(file, entry: dict, with_payload: bool) -> tuple:
    """A record by its index entry alone: page_id, url, type, id, record referred to, payload's size and digest, payload.

    A revisit's size and digest are those of the payload that it repeats.
    """
    file.seek(entry["offset"])

    def take(fields: Header, block: Iterator[bytes]) -> tuple:
        kind, record, refers_to = fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To")
        payload, size, digest = None, None, None
        if kind in ("response", "revisit"):
            head, pieces = _http(block)
            sha1, size, kept = hashlib.sha1(), 0, []
            for piece in pieces:
                sha1.update(piece)
                size += len(piece)
                if with_payload:
                    kept.append(piece)
            digest = _base32(sha1)
            if kind == "revisit":
                size = int(re.search(rb"(?im)^content-length: *(\d+)", head)[1])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            elif with_payload:
                payload = b"".join(kept)
        return _page_of(record), fields.get("WARC-Target-URI"), kind, record, refers_to, _page_of(refers_to), size, digest, payload

    (found,) = records_of(Inflated(_chunks(file, entry["length"])), take)
    return found


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All response and revisit records of the archives (archive, sidecar), each found by its offset in the sidecar; READ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            disk, base = fs.FileSystem.from_uri(folder)
            for batch in batches:
                for archive, sidecar in zip(batch["archive"].to_pylist(), batch["sidecar"].to_pylist()):
                    with disk.open_input_file(f"{base}/{archive}") as file, disk.open_input_stream(f"{base}/{sidecar}", compression=None) as index:
                        for line in _lines(index):
                            entry = json.loads(line)
                            if entry["type"] in ("response", "revisit"):
                                *told, payload = read_record(file, entry, with_payload)
                                yield *told, archive, entry["offset"], entry["length"], payload

        yield from _rows(READ, rows())

    return archives.mapInArrow(run, READ)


def _lines(file) -> Iterator[bytes]:
    rest = b""
    for piece in _chunks(file):
        *lines, rest = (rest + piece).split(b"\n")
        yield from lines


def archive_pages(pages: DataFrame, least_bytes: int = 0, with_payload: bool = True) -> DataFrame:
    """The records of ``pages`` (page_id, url, html) read back from archives, one per row; columns of READ.

    Every page is written once to a monolithic gzip archive; every archive is then inflated once and rewritten with a
    gzip member per record, repeated payloads becoming revisits of the one with the largest page_id, and a sidecar of
    offsets; the records are read by these offsets. NULL html is an empty payload, empty payloads count as equal;
    a NULL page_id is smaller than any other, and of repeated rows one is the response. A NULL url has no header.
    Very long payloads pass in pieces until they are read with their payload. No pages, no records. Other columns are
    not looked at. The files lie in the shared folder; rows of finished tasks name those that count.
    """
    spark = pages.sparkSession
    tables = Tables(spark, "warc")
    folder = f"{tables.folder}/archives"
    records = tables.keep(write_archives(pages, folder))
    archives = tables.keep(revisits_of(records, least_bytes))
    normal = tables.keep(normalise_archives(_dealt(archives), folder))
    return read_archives(_dealt(normal), folder, with_payload)
