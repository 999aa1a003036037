"""WARC records inside one task: written as gzip members, read back as a stream."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs

CRLF = b"\r\n"
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT_TYPE = "application/http; msgtype=response"
ID_PREFIX, ID_END = "<urn:x-page:", ">"
# The table has no time of capture.
DATE = "1970-01-01T00:00:00Z"

ARCHIVE_BYTES = 32_000_000
_READ_BYTES = 1 << 18


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(fields: list[tuple[str, str]], first: bytes) -> bytes:
    return CRLF.join([first, *[f"{k}: {v}".encode() for k, v in fields], b"", b""])


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member; a revisit has the HTTP header of its page and no payload."""
    block = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
                    b"HTTP/1.1 200 OK")
    if not revisit:
        block += payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"{ID_PREFIX}{'' if page is None else page}{ID_END}"), ("WARC-Date", DATE)]
    if url is not None:
        # Blanks and controls would end the field.
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"{ID_PREFIX}{refers_to}{ID_END}")]
    fields += [("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
               ("Content-Type", CONTENT_TYPE), ("Content-Length", str(len(block)))]
    squeeze = zlib.compressobj(wbits=31)
    return squeeze.compress(_header(fields, VERSION) + block + CRLF + CRLF) + squeeze.flush()


def write_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """(page, url, html, refers_to, revisit) in; (path, records, bytes) of each archive out.

    An archive gets a new name in every attempt of a task and counts only if the attempt's rows
    do, so a repeated task leaves no record twice.
    """
    files, inner = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(inner)
    stream = None
    done = []
    for batch in batches:
        for i in range(batch.num_rows):
            page, url, html, refers_to, revisit = (c[i].as_py() for c in batch.columns)
            if stream is None:
                name = f"pages-{uuid.uuid4().hex}.warc.gz"
                stream = files.open_output_stream(f"{inner}/{name}", compression=None)
                count = size = 0
            member = record(page, url, (html or "").encode(), refers_to, revisit)
            stream.write(member)
            count, size = count + 1, size + len(member)
            if size >= ARCHIVE_BYTES:
                stream.close()
                done.append((f"{folder}/{name}", count, size))
                stream = None
    if stream is not None:
        stream.close()
        done.append((f"{folder}/{name}", count, size))
    paths, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()),
                                      pa.array(sizes, pa.int64())], ["path", "records", "bytes"])


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes
    payload_bytes: int
    intact: bool

    def digest(self) -> str:
        return self.fields.get("warc-payload-digest", "").removeprefix("sha1:")


class _Member:
    """The decompressed bytes of one gzip member, taken in order."""

    def __init__(self, source, pending: bytes):
        self.source, self.pending = source, pending
        self.gzip, self.buffer = zlib.decompressobj(wbits=31), bytearray()

    def more(self) -> bool:
        """Decompress a bounded amount more; False at the end of the member."""
        if self.gzip.eof:
            return False
        data = self.gzip.unconsumed_tail or self.pending or self.source.read(_READ_BYTES)
        self.pending = b""
        if not data:
            raise ValueError("the archive ends inside a record")
        self.buffer += self.gzip.decompress(data, 4 * _READ_BYTES)
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark))
            if not self.more():
                raise ValueError("a record header has no end")
        return self.take(found + len(mark))

    def take(self, count: int) -> bytes:
        while len(self.buffer) < count:
            if not self.more():
                raise ValueError("a record is shorter than its length says")
        taken = bytes(self.buffer[:count])
        del self.buffer[:count]
        return taken

    def finish(self) -> bytes:
        """What follows the member, after its end was checked."""
        if self.take(4) != CRLF + CRLF or self.buffer:
            raise ValueError("a record is longer than its length says")
        while self.more():
            if self.buffer:
                raise ValueError("a record is longer than its length says")
        return self.gzip.unused_data


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def read_records(source) -> Iterator[Record]:
    """The records of an archive in order; ``source`` needs ``read(n)`` only.

    Compressed bytes are taken in bounded pieces and each record by its content length. A record
    is intact when the digests of its block, and of its payload if it has one, are the stated ones.
    """
    pending = source.read(_READ_BYTES)
    while pending:
        member = _Member(source, pending)
        header = member.until(CRLF + CRLF)
        if not header.startswith(b"WARC/"):
            raise ValueError("this is not a WARC record")
        fields = _fields(header)
        block = member.take(int(fields["content-length"]))
        pending = member.finish() or source.read(_READ_BYTES)
        head, _, payload = block.partition(CRLF + CRLF)
        http = _fields(head)
        intact = fields.get("warc-block-digest") == f"sha1:{base32_sha1(block)}"
        if fields.get("warc-type") == "response":
            intact = intact and fields.get("warc-payload-digest") == f"sha1:{base32_sha1(payload)}" \
                and int(http.get("content-length", -1)) == len(payload)
        yield Record(fields, payload, int(http.get("content-length", 0)), intact)


def read_batches(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    """(path) in; a row per record out, in pieces of bounded size."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                 pa.binary(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["record_id", "record_type", "target_uri", "refers_to", "payload_digest",
             "payload_bytes", "payload", "intact"])
    for paths in batches:
        for path in paths.column(0).to_pylist():
            files, inner = pa.fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with files.open_input_stream(inner, compression=None) as source:
                for r in read_records(source):
                    response = r.fields.get("warc-type") == "response"
                    rows.append((r.fields.get("warc-record-id"), r.fields.get("warc-type"),
                                 r.fields.get("warc-target-uri"), r.fields.get("warc-refers-to"), r.digest(),
                                 r.payload_bytes, r.payload if payloads and response else None, r.intact))
                    size += len(r.payload) * payloads + 200
                    if size > 4_000_000:
                        yield batch(rows)
                        rows, size = [], 0
            if rows:
                yield batch(rows)
