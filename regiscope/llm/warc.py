"""WARC archives of pages and a normaliser for archives that are one gzip stream.

`archives` writes a record per page into archives that are each a single gzip stream. `normalise`
inflates such a stream once, from start to end, writes every record as a gzip member of its own and
notes offset and length of each member in a sidecar index. `records` reads members by that index.
These are tables in the shared folder (archive name, bytes, index), so any executor can read what another
has written; an archive is closed at `ARCHIVE_BYTES`, which bounds a task's memory. `normalise_files` does
the same with files of any size and writes files and sidecar indexes.

Of pages with equal payloads (empty ones too) that with the largest page_id is the response, the others
are revisits of it; rows that share that page_id are all responses. A null html is an empty payload; a
null page_id counts as smaller than any other. A null url is written as an empty target. Repeated rows are records of
their own; other columns are ignored. A payload that very many pages share is broadcast with its response, so its pages
stay where they are; texts are worked on row by row, however long.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import posixpath
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import join_by_count, materialise, small

ARCHIVE_BYTES = 8 << 20
LEVEL = 3
INDEX_ROWS = 50_000
OWNERS_BROADCAST = 500_000
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
INDEX = pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record (without payload) where refers_to is given."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Target-URI", (url or "").replace("\r", " ").replace("\n", " ")), ("WARC-Payload-Digest", "sha1:" + digest(payload)), ("X-Payload-Length", str(len(payload)))]
    block = HTTP + payload if refers_to is None else HTTP
    if refers_to is not None:
        head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-cased names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields, rest[: int(fields.get("content-length", 0))]


def normalise(read: Callable[[int], bytes], write: Callable[[bytes], object], level: int = LEVEL) -> Iterator[tuple[int, int, str]]:
    """Rewrite a gzip stream of WARC records as a member for each record; yields (offset, length, record id).

    read(n) gives the next bytes of the archive (several concatenated members are read as well), write takes
    bytes of the new one. Only one record is held at a time. A cut stream raises EOFError.
    """
    inflate, buffer, at, ended = zlib.decompressobj(31), bytearray(), 0, False

    def more() -> bool:
        nonlocal inflate, ended
        while not ended:
            raw = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            raw = raw or read(1 << 18)
            if not raw:
                ended = True
                break
            if got := inflate.decompress(raw):
                buffer.extend(got)
                return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if buffer.strip():
                raise EOFError("the archive ends inside a record")
            return
        fields, _ = parse(bytes(buffer[: end + 4]))
        size = end + 4 + int(fields.get("content-length", 0)) + 4
        while len(buffer) < size and more():
            pass
        if len(buffer) < size:
            raise EOFError("the archive ends inside a record")
        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = pack.compress(bytes(buffer[:size])) + pack.flush()
        del buffer[:size]
        write(member)
        yield at, len(member), fields.get("warc-record-id", "")
        at += len(member)


def with_owners(pages: DataFrame) -> DataFrame:
    """page_id, url, html and refers_to: the response of equal payloads where that is another page."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("payload", F.sha1("html"))
    owners = materialise(p.groupBy("payload").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1"))
    joined = p.join(F.broadcast(owners.drop("n")), "payload", "left") if owners.count() <= OWNERS_BROADCAST else join_by_count(p, owners, ["payload"], "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner")).alias("refers_to"))


def archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, data): archives that are one gzip stream each, in the shared folder."""
    def run(batches):
        pack, parts, size = None, [], 0

        def close():
            parts.append(pack.flush())
            return pa.RecordBatch.from_pydict({"archive": [f"pages-{uuid.uuid4().hex}.warc.gz"], "data": pa.array([b"".join(parts)], pa.binary())})

        for b in small(batches):
            for page_id, url, html, refers_to in zip(*(b.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                raw = record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "replace"), refers_to.as_py())
                if pack is None:
                    pack, parts, size = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), [], 0
                parts.append(pack.compress(raw))
                size += len(raw)
                if size >= archive_bytes:
                    yield close()
                    pack = None
        if pack is not None:
            yield close()

    return materialise(with_owners(pages).mapInArrow(run, "archive string, data binary"))


def normalised(monolithic: DataFrame) -> DataFrame:
    """(archive, data, index): every record a member of its own, with the sidecar index, in the shared folder."""
    def run(batches):
        for b in small(batches):
            for name, data in zip(b.column("archive").to_pylist(), b.column("data")):
                out = io.BytesIO()
                index = [{"offset": o, "length": n, "record_id": r} for o, n, r in normalise(io.BytesIO(data.as_py()).read, out.write)]
                yield pa.RecordBatch.from_pydict({"archive": [name], "data": pa.array([out.getvalue()], pa.binary()), "index": pa.array([index], pa.list_(INDEX))})

    return materialise(monolithic.mapInArrow(run, "archive string, data binary, index array<struct<offset:long,length:long,record_id:string>>"))


def records(members: DataFrame) -> DataFrame:
    """A row per record, read from its member by the index; a response's payload is hashed again and must match its header."""

    def page(urn: str) -> int | None:
        return int(urn[len("<urn:page:") : -1]) if urn[len("<urn:page:") : -1] else None

    def run(batches):
        for b in small(batches):
            for data, index in zip(b.column("data"), b.column("index").to_pylist()):
                view, rows = memoryview(data.as_buffer()), []
                for at in index:
                    fields, block = parse(zlib.decompress(view[at["offset"] : at["offset"] + at["length"]], 31))
                    kind, said, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                    if kind == "response":
                        payload = block[len(HTTP) :]
                        if digest(payload) != said or len(payload) != size:
                            raise ValueError(f"record {at['record_id']} is damaged")
                    rows.append((page(fields["warc-record-id"]), size, said, kind, page(fields.get("warc-refers-to", "<urn:page:>"))))
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return members.mapInArrow(run, RESULT)


def normalise_files(files: DataFrame, folder: str) -> DataFrame:
    """Normalises WARC files (column path, as of a binaryFile listing) of any size; a row per record: file, offset, length, record_id.

    A file is read once, as a stream, by a task of its own, which holds one record at a time. It writes the file of the same
    name in `folder`, with every record a gzip member, and beside it `<name>.index`, a JSON object of offset, length and
    record_id in each line. Files of one name in different folders are `<16 digits of the path's SHA-256>-<name>` there.
    Both files get their names when they are complete, the index first, so an archive never stands without its index, and a
    task may run again. Paths are opened with pyarrow's file systems (local, HDFS, S3 and the like). A damaged file raises
    EOFError or zlib.error and leaves nothing; no rows of any file are given then.
    """
    base = folder if ":" in folder else f"file://{folder}"
    name = F.element_at(F.split("path", "/"), -1)
    listed = files.select("path").distinct().withColumn("name", name)
    listed = listed.withColumn("name", F.when(F.count("*").over(Window.partitionBy("name")) > 1, F.concat(F.substring(F.sha2("path", 256), 1, 16), F.lit("-"), "name")).otherwise(F.col("name")))
    listed = materialise(listed.withColumn("task", F.row_number().over(Window.orderBy("path")) - 1))  # a listing: a row a file
    dealt = listed.repartitionById(max(1, listed.count()), F.col("task"))

    def run(batches):
        out, at = fs.FileSystem.from_uri(base)
        out.create_dir(at, recursive=True)
        for b in batches:
            for path, name in zip(b.column("path").to_pylist(), b.column("name").to_pylist()):
                system, source = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
                to, part = posixpath.join(at, name), posixpath.join(at, f".{uuid.uuid4().hex}")
                try:
                    with system.open_input_stream(source, compression=None) as raw, out.open_output_stream(part, compression=None) as new, out.open_output_stream(part + ".index", compression=None) as index:
                        rows = []
                        for offset, length, record_id in normalise(raw.read, new.write):
                            rows.append((offset, length, record_id))
                            if len(rows) == INDEX_ROWS:
                                yield _indexed(to, rows, index)
                                rows = []
                        yield _indexed(to, rows, index)
                    out.move(part + ".index", to + ".index")
                    out.move(part, to)
                finally:
                    for left in (part, part + ".index"):
                        if out.get_file_info(left).type != fs.FileType.NotFound:
                            out.delete_file(left)

    return materialise(dealt.mapInArrow(run, "file string, offset long, length long, record_id string"))


def _indexed(file: str, rows: list[tuple], index) -> pa.RecordBatch:
    """Writes lines of a sidecar index; the same as a batch."""
    index.write("".join(json.dumps(dict(zip(("offset", "length", "record_id"), r))) + "\n" for r in rows).encode())
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string())))], names=["file", "offset", "length", "record_id"])


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back."""
    return records(normalised(archives(pages)))
