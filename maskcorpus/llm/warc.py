"""WARC archives: a writer with revisit records and a sequential reader.

Every record is one gzip member. The reader takes an archive from front to
back: incremental zlib decompression of one member, its header, content-length
framing of the block, and the digests of block and payload. It holds one
record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import scratch_path, staged

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Compressed bytes after which a writer starts its next archive; one task reads an archive.
ARCHIVE_BYTES = 16_000_000
READ_BYTES = 1 << 20
END = b"\r\n\r\n"


class WarcError(ValueError):
    """An archive that does not follow the format."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def open_folder(uri: str):
    """(file system, path) for a folder that Spark names; plain paths and ``file:`` are the local file system."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "file://" + re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


# --- writing -------------------------------------------------------------------------------------------------------


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + END + block + END) + squeeze.flush()


def _uri(url: str) -> str:
    """A url as a header value: control characters and blanks are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The response of a page, or a revisit record that refers to another page's response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    name = "null" if page_id is None else page_id
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    return member(headers, http + (payload if refers_to is None else b""))


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to) of ``pages(page_id, url, html)``.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the largest page_id is the response (refers_to null) and the others refer
    to it. Null html is the empty payload. Rows that repeat the largest id
    cannot be told apart and are all responses; pages without an id refer to
    one with an id if there is one. Digests are counted before the join, and
    only those of several pages enter it.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")).withColumn(
        "digest", F.sha1("payload"))
    several = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
               .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("of"), "first"))
    several = staged(several, "copies")
    joined = rows.join(several, F.col("digest") == F.col("of"), "left")
    return joined.select("page_id", "url", "payload",
                         F.expr("case when not (page_id <=> first) then first end").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages as ``.warc.gz`` files and return the list (path, records, bytes) of those that count.

    ``folder`` must be seen by all machines (default: below
    ``spark.checkpoint.dir``). Every attempt of a task writes names of its
    own and only a finished attempt's names get into the list, so a lost
    executor leaves files that nobody reads. A table without rows gives no archive.
    """
    folder = folder or scratch_path(pages.sparkSession, "archives")

    def run(batches):
        files, path = open_folder(folder)
        files.create_dir(path, recursive=True)
        run_id, out, name, records, size, k = uuid.uuid4().hex, None, None, 0, 0, 0
        for batch in batches:
            done = []
            for page_id, url, payload, refers_to in zip(*((v.as_py() for v in c) for c in batch.columns)):
                if out is None:
                    name = f"pages-{run_id}-{k:05d}.warc.gz"
                    out, records, size, k = files.open_output_stream(f"{path}/{name}", compression=None), 0, 0, k + 1
                    info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size += len(info)
                data = page_record(page_id, url, payload, refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
            if done:
                yield _listing(folder, done)
        if out is not None:
            out.close()
            yield _listing(folder, [(name, records, size)])

    rows = with_revisits(pages, min_bytes)
    return staged(rows.mapInArrow(run, "path string, records long, bytes long"), "archive-list")


def _listing(folder: str, done: list[tuple]) -> pa.RecordBatch:
    names, records, sizes = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in names]), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                                      names=["path", "records", "bytes"])


#: Compressed bytes of archives that one task reads.
TASK_BYTES = 256_000_000

# --- reading -------------------------------------------------------------------------------------------------------


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    def get(self, name: str) -> str | None:
        return self.headers.get(name.lower())


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        k, colon, v = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise WarcError(f"no header: {line[:40]!r}")
        out.setdefault(k.strip().lower(), v.strip())
    return out


def _members(stream) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(offset, decompressed pieces) of each gzip member; the pieces must be used up before the next member."""
    at, rest = 0, b""
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        inflate, start = zlib.decompressobj(31), at

        def pieces():
            nonlocal at, rest
            while not inflate.eof:
                data = rest or stream.read(READ_BYTES)
                if not data:
                    raise WarcError("the archive ends inside a record")
                try:
                    out = inflate.decompress(data, READ_BYTES)
                except zlib.error as e:
                    raise WarcError(f"not a gzip member: {e}") from None
                rest = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
                at += len(data) - len(rest)
                if out:
                    yield out
        yield start, pieces()


def records(stream) -> Iterator[Record]:
    """The records of an open archive in order: one gzip member each, framed by Content-Length."""
    for offset, pieces in _members(stream):
        buffer = bytearray()
        for piece in pieces:
            buffer += piece
            if END in buffer[max(0, len(buffer) - len(piece) - 3):]:
                break
        head, end, _ = bytes(buffer).partition(END)
        first, *lines = head.split(b"\r\n")
        if not end or not re.fullmatch(rb"WARC/1\.[01]", first):
            raise WarcError(f"no WARC record at {offset}")
        headers = _headers(lines)
        length = headers.get("content-length", "")
        if not length.isdigit():
            raise WarcError(f"no Content-Length at {offset}")
        start, size = len(head) + len(END), int(length)
        del buffer[:start]
        for piece in pieces:
            if len(buffer) > size + len(END):
                break
            buffer += piece
        if len(buffer) != size + len(END) or buffer[size:] != END:
            raise WarcError(f"the record at {offset} has not the length it says")
        yield Record(offset, headers, bytes(buffer[:size]))


def _digest_fault(name: str, said: str | None, data: bytes) -> str | None:
    return f"{name} digest differs" if said is not None and said != f"sha1:{base32_sha1(data)}" else None


def _page(record: Record) -> tuple:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, fault) of a page's record."""
    head, end, payload = record.block.partition(END)
    http = _headers(head.split(b"\r\n")[1:]) if end else {}
    kind, digest = record.get("WARC-Type"), record.get("WARC-Payload-Digest")
    fault = _digest_fault("block", record.get("WARC-Block-Digest"), record.block)
    said = http.get("content-length", "")
    if kind == "response":
        fault = fault or _digest_fault("payload", digest, payload) or (None if said == str(len(payload)) else "payload length differs")
    name = lambda v: int(m[1]) if v and (m := re.fullmatch(r"<urn:page:(-?\d+)>", v)) else None
    return (name(record.get("WARC-Record-ID")), record.get("WARC-Target-URI"), payload if kind == "response" else None,
            int(said) if said.isdigit() else None, digest.removeprefix("sha1:") if digest else None, kind, name(record.get("WARC-Refers-To")), fault)


READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("fault", pa.string()),
                  ("path", pa.string()), ("offset", pa.int64())])
READ_SQL = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "fault string, path string, offset long")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per response and revisit record of the archives listed in ``archives(path)``.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload,
    for a revisit too (its HTTP header and digest header have them). A digest
    or length that does not hold is named in ``fault``, otherwise null; what
    breaks the framing (a cut file, no gzip, no Content-Length) ends its
    archive with a row that has only fault, path and offset, as does a path
    that is null or that no file has any more. ``payloads`` false leaves the
    payload column null after verification. An empty list gives no rows, a
    path that is listed twice is read twice, other columns than path and
    bytes are not read. Archives are dealt evenly over ``reading_tasks`` tasks.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from _read(path, payloads)

    # an explicit number of partitions is not coalesced, however small the list of paths is
    listed = archives.select("path", (F.col("bytes") if "bytes" in archives.columns else F.lit(None)).cast("long").alias("bytes"),
                             F.monotonically_increasing_id().alias("at"))
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    dealt = listed.repartitionByRange(reading_tasks(archives.sparkSession, n, size), F.xxhash64("path", "at"))
    return dealt.select("path").mapInArrow(run, READ_SQL)


def reading_tasks(spark: SparkSession, archives: int, size: int) -> int:
    """Tasks that read so many archives of ``size`` bytes: TASK_BYTES each, all cores if there are archives for them."""
    return max(1, min(archives, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))


def _read(path: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    if path is None:
        yield _batch([(None,) * 7 + ("no path", None, 0)])
        return
    folder, _, name = path.rpartition("/")
    files, base = open_folder(folder)
    if files.get_file_info(f"{base}/{name}").type.name == "NotFound":
        yield _batch([(None,) * 7 + ("no such file", path, 0)])
        return
    held, size, last = [], 0, 0
    with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
        try:
            for record in records(stream):
                last = record.offset
                if record.get("WARC-Type") in ("response", "revisit"):
                    row = list(_page(record))
                    size += len(row[2] or b"") + 200
                    if not payloads:
                        row[2] = None
                    held.append((*row, path, record.offset))
                    if size > 4 << 20:
                        yield _batch(held)
                        held, size = [], 0
        except WarcError as e:
            held.append((None,) * 7 + (str(e), path, last))
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), READ.types)], schema=READ)
