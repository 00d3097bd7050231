"""Web archives: writing, normalising whole-file gzip streams, and reading by offset.

An archive compressed as one gzip stream can only be read from its start. The normaliser inflates such a stream
once, in pieces, writes each record as a gzip member of its own to a new archive, and writes an index of offsets
beside it; each record can then be read alone. Archives are independent, so they are spread over the tasks.

Files are written below a folder that all executors share. A task that is run again writes files of new names,
and only the files listed by the run that counted are used.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.session import work_path

PIECE = 1 << 20
VERSION = 1 << 16  # a longer first line is none; other header lines have any length
GZIP = 31  # zlib's code for gzip headers
MANIFEST = "path string, n_records long, n_bytes long"
INDEX = "path string, offset long, length long, record_id string, record_type string, problem string"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: pages as responses, or as revisits of an equal payload.

    Among payloads of at least ``min_bytes`` bytes that are equal, rows of the smallest id are responses and the
    others refer to it (all are responses if none has an id). A null page is empty.
    """
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.concat_ws(":", F.sha1("payload"), F.octet_length("payload")))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (
        F.octet_length("payload") >= min_bytes)
    return rows.join(first, "digest").select("page_id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit that keeps the response's headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[4:4] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                     f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, *, date: str = "2024-01-01T00:00:00Z", level: int = 3,
                   roll: int = 64 << 20) -> DataFrame:
    """Write records to archives of one gzip stream each; a new one begins after ``roll`` bytes. Returns the manifest."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        out, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, gz, n, size = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, wbits=GZIP), 0, 0
                data = record_bytes(row["page_id"], row["url"], row["payload"], row["refers_to"], date)
                out.write(gz.compress(data))
                n, size = n + 1, size + len(data)
                if size >= roll:
                    out.write(gz.flush())
                    out.close()
                    done.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            done.append((f"{folder}/{name}", n, size))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "n_records", "n_bytes"), d)) for d in done], pa.schema(
            [("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return saved(rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, MANIFEST), "warc-manifest")


class Inflated:
    """The bytes of a gzip file of one or more members, read forward in pieces."""

    def __init__(self, file: object):
        self.file, self.gz, self.buffer, self.ended = file, zlib.decompressobj(GZIP), bytearray(), False

    def _fill(self) -> bool:
        if self.gz.unconsumed_tail:
            data = self.gz.unconsumed_tail
        elif self.gz.eof:
            data = self.gz.unused_data or self.file.read(PIECE)
            if data:
                self.gz = zlib.decompressobj(GZIP)
        else:
            data = self.file.read(PIECE)
            if not data:
                raise EOFError("the gzip stream ends early")
        if not data:
            return False
        self.buffer += self.gz.decompress(data, PIECE)
        return True

    def line(self, most: int | None = None) -> bytes:
        """The next line, however long; an error if it has ``most`` bytes or more."""
        at = seen = 0
        while (at := self.buffer.find(b"\n", seen)) < 0 and (most is None or len(self.buffer) < most):
            seen = len(self.buffer)
            if not self._fill():
                break
        if most is not None and (at if at >= 0 else len(self.buffer)) >= most:
            raise ValueError("a header line is too long")
        out = bytes(self.buffer[:at + 1] if at >= 0 else self.buffer)
        del self.buffer[:len(out)]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._fill():
                raise EOFError("a record ends early")
            out = bytes(self.buffer[:min(n, PIECE)])
            del self.buffer[:len(out)]
            n -= len(out)
            if out:
                yield out


def read_head(stream: Inflated) -> tuple[bytes, dict[str, str]] | None:
    """The next record's header as it is and by lower-case name; None at the end."""
    raw = stream.line(VERSION)
    while raw in (b"\r\n", b"\n"):
        raw = stream.line(VERSION)
    if not raw:
        return None
    if not raw.startswith(b"WARC/"):
        raise ValueError("no record begins here")
    fields: dict[str, str] = {}
    while (line := stream.line()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("a header ends early")
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
        raw += line
    return raw + b"\r\n", fields


def normalise(manifest: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive of the manifest (``path``) with a member for each record, and an index beside it.

    Returns the index: ``path, offset, length, record_id, record_type``. An archive that is damaged keeps the
    records before the damage, and gets one more row that names the ``problem``.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("record_id", pa.string()), ("record_type", pa.string()), ("problem", pa.string())])
        target, base = _open(folder)
        target.create_dir(base, recursive=True)
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            system, source = _open(path)
            name = f"{uuid.uuid4().hex}.warc.gz"
            rows, offset, new = [], 0, f"{folder}/{name}"
            with system.open_input_stream(source, compression=None) as file, \
                    target.open_output_stream(f"{base}/{name}", compression=None) as out, \
                    target.open_output_stream(f"{base}/{name}.idx", compression=None) as side:
                stream = Inflated(file)
                while True:
                    length = 0
                    try:
                        head = read_head(stream)
                        if head is None:
                            break
                        raw, fields = head
                        gz = zlib.compressobj(level, wbits=GZIP)
                        waiting = [gz.compress(raw)]
                        for piece in stream.pieces(int(fields["content-length"])):
                            waiting.append(gz.compress(piece))
                            if sum(map(len, waiting)) >= PIECE:
                                length += out.write(b"".join(waiting))
                                waiting = []
                        length += out.write(b"".join([*waiting, gz.compress(b"\r\n\r\n"), gz.flush()]))
                    except (EOFError, ValueError, KeyError, zlib.error) as problem:
                        rows.append((new, offset, length, None, None, f"{path}: {problem!r}"))
                        break
                    entry = (new, offset, length, fields.get("warc-record-id"), fields.get("warc-type"), None)
                    side.write((json.dumps(dict(zip(("offset", "length", "id", "type"), entry[1:5]))) + "\n").encode())
                    rows.append(entry)
                    offset += length
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    paths = manifest.select("path")
    return saved(paths.repartition(max(1, paths.count())).mapInArrow(rewrite, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records at the index's offsets: ``path, offset, page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A response's payload is read and its digest computed; a revisit has both in its headers.
    """
    schema = ("path string, offset long, page_id long, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long")

    def number(urn: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64())])
        opened, file = "", None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["path"] != opened:
                    if file:
                        file.close()
                    system, source = _open(row["path"])
                    opened, file = row["path"], system.open_input_file(source)
                file.seek(row["offset"])
                member = zlib.decompress(file.read(row["length"]), GZIP)
                head, _, block = member.partition(b"\r\n\r\n")
                fields = dict((k.lower(), v) for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:]))
                block = block[:int(fields["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                revisit = fields["warc-type"] == "revisit"
                size = int(re.search(rb"(?i)\r\nContent-Length: *([0-9]+)", http)[1]) if revisit else len(payload)
                digest = fields["warc-payload-digest"].removeprefix("sha1:") if revisit else base32_sha1(payload)
                rows.append((row["path"], row["offset"], number(fields["warc-record-id"]), size, digest,
                             fields["warc-type"], number(fields.get("warc-refers-to"))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
        if file:
            file.close()

    return index.where("problem IS NULL").select("path", "offset", "length").mapInArrow(read, schema)


def checked(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """The index, if it has every record that the manifest counts and no problem; an error otherwise."""
    written = manifest.agg(F.sum("n_records")).first()[0] or 0
    found, problems, one = index.agg(F.count(F.when(F.col("problem").isNull(), 1)), F.count("problem"), F.min("problem")).first()
    if problems or found != written:
        raise ValueError(f"{written} records were written, {found} were found, {problems} archives are damaged: {one}")
    return index


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as records, normalise the archives, and read every record back through the index.

    Raises if an archive can't be read to its end or holds other than the records written.
    """
    folder = work_path(pages.sparkSession, "warc")
    manifest = write_archives(records(pages, min_bytes), f"{folder}/whole")
    return read_records(checked(normalise(manifest, f"{folder}/members"), manifest))
