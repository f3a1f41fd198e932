"""Zip archives as tables. Archives are cut into splits by their bytes, and an entry belongs to the split its own header lies in.

`ZipEntries` is a data source whose partitions are these splits: they follow from the archives' lengths alone, so many small
archives are as many tasks and one large one is many. Of an archive of several splits, a task first passes over the directory at
its end, an entry at a time and never held, and notes in which stretch of it each split's entries stand; a split's task reads its
stretch, and of the contents only its own entries, with filters on the company number applied before that. Archives are packed by
all tasks and written without holding a directory, too. The CSV inside a zip is one compressed stream: it is passed over once for an index of checkpoints (see `inflate`), and
then read by a task for each stretch between two of them. Archives are opened by their address with pyarrow's file systems
(local, HDFS, S3 and the like), which read only what a task asks for.
"""

from __future__ import annotations

import bisect
import collections
import csv
import functools
import io
import itertools
import json
import pickle
import posixpath
import struct
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from regiscope.sources.io import scratch
from regiscope.sources.inflate import Checkpoint, Inflater, checkpoints

ENTRIES = "archive string, entry string, companynumber string, size long, ordinal int, split int, content binary, error string"
#: Most and fewest bytes of a split, and splits for each core where archives are large enough.
SPLIT, LEAST_SPLIT, PER_CORE = 1 << 26, 1 << 20, 3
#: Contents are handed on in pieces of about so many bytes.
PIECE = 1 << 24
#: Bytes of text between checkpoints of a compressed CSV.
SPAN = 1 << 24
DAMAGED = (zipfile.BadZipFile, zlib.error, struct.error, pa.ArrowInvalid, OSError, EOFError, NotImplementedError, RuntimeError)


def _file(path: str) -> pa.NativeFile:
    system, name = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
    return system.open_input_file(name)


#: The records of the zip format that a directory is found and read by, and the most bytes that the one at the end can have.
END, END64, PLACE64, ENTRY = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4sLQL"), struct.Struct("<4s4B4HL2L5H2L")
LONGEST_END = END.size + (1 << 16)


def _directory_of(file) -> tuple[int, int, int]:
    """Place of an archive's directory, its bytes, and how many bytes stand before the archive."""
    size = file.size() if hasattr(file, "size") else file.seek(0, 2)
    start = max(0, size - LONGEST_END - PLACE64.size)
    file.seek(start)
    tail = file.read(size - start)
    at = tail.rfind(b"PK\5\6", 0, max(0, len(tail) - END.size + 4))
    if at < 0:
        raise zipfile.BadZipFile("File is not a zip file")
    *_, length, offset, _ = END.unpack_from(tail, at)
    before = at - PLACE64.size
    if before >= 0 and tail[before : before + 4] == b"PK\6\7":
        at = before - END64.size  # the large form of the record stands right before its place
        if at >= 0 and tail[at : at + 4] == b"PK\6\6":
            *_, length, offset = END64.unpack_from(tail, at)
        else:
            raise zipfile.BadZipFile("Corrupt zip64 end of central directory record")
    begin = start + at - length
    if begin < 0 or begin < offset:
        raise zipfile.BadZipFile("Bad offset for central directory")
    return begin, length, begin - offset


def _directory(file) -> Iterator[tuple]:
    """(name, flags, method, check sum, packed size, size, place) of an archive's entries in the order of its directory, one after the other: memory does not grow with their number."""
    return (entry for _, entry in _records(file, *_directory_of(file)))


def _records(file, at: int, left: int, shift: int) -> Iterator[tuple[int, tuple]]:
    """The entries whose records stand in `left` bytes of a directory from `at` on, each with the place after its record."""
    held, k, after = b"", 0, at

    def need(n: int) -> None:
        nonlocal held, k, at, left
        if len(held) - k < n:
            file.seek(at)
            more = file.read(min(left, max(1 << 20, n)))
            held, k, at, left = held[k:] + more, 0, at + len(more), left - len(more)
            if len(held) < n:
                raise zipfile.BadZipFile("Truncated central directory")

    while len(held) - k or left:
        need(ENTRY.size)
        magic, made, system, needs, reserved, flags, method, time, date, crc, packed, size, name, extra, comment, disk, inner, outer, offset = ENTRY.unpack_from(held, k)
        if magic != b"PK\1\2":
            raise zipfile.BadZipFile("Bad magic number for central directory")
        need(ENTRY.size + name + extra + comment)
        raw, more = held[k + ENTRY.size : k + ENTRY.size + name], held[k + ENTRY.size + name : k + ENTRY.size + name + extra]
        k += ENTRY.size + name + extra + comment
        after += ENTRY.size + name + extra + comment
        while len(more) >= 4 and 0xFFFFFFFF in (size, packed, offset):  # numbers of over 4 GB stand in an extra field, those that did not fit, in this order
            kind, n = struct.unpack_from("<HH", more)
            if kind == 1:
                large = iter(v for (v,) in struct.iter_unpack("<Q", more[4 : 4 + n - n % 8]))
                try:
                    size, packed, offset = (next(large) if v == 0xFFFFFFFF else v for v in (size, packed, offset))
                except (RuntimeError, StopIteration) as e:
                    raise zipfile.BadZipFile("Corrupt zip64 extra field") from e
                break
            more = more[4 + n :]
        yield after, (raw.decode("utf-8" if flags & 0x800 else "cp437"), flags, method, crc, packed, size, offset + shift)


def _info(entry: tuple) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(entry[0])
    info.orig_filename, info.flag_bits, info.compress_type, info.CRC, info.compress_size, info.file_size, info.header_offset = entry
    return info


def _contents(file) -> zipfile.ZipFile:
    """What opens the entries of an archive, without its directory."""
    z = zipfile.ZipFile(io.BytesIO(END.pack(b"PK\5\6", *[0] * 7)))
    z.fp = file
    return z


class Split(InputPartition):
    """Entries of one archive whose headers lie from byte `low` on, before `high` (None: to the end).

    `stretch` says, if known, where their records stand: place, bytes, how many bytes stand before the archive, and the first one's ordinal; or what is wrong with the directory.
    """

    def __init__(self, number: int, path: str, low: int, high: int | None, stretch: list | str | None = None):
        self.number, self.path, self.low, self.high, self.stretch = number, path, low, high, stretch


def splits(files: list[tuple[str, int]], size: int) -> list[Split]:
    """Splits of about `size` bytes of archives (path, length); a smaller archive is one split."""
    cuts = [(path, k * size, (k + 1) * size if (k + 1) * size < length else None) for path, length in files for k in range(max(1, -(-length // size)))]
    return [Split(k, *cut) for k, cut in enumerate(cuts)]


def stretches(path: str, cuts: list[int]) -> list[list | str]:
    """Of an archive cut into splits that begin at these bytes, where in the directory each one's entries stand: one pass."""
    found = [None] * len(cuts)
    try:
        with _file(path) as file:
            at, left, shift = _directory_of(file)
            for k, (after, entry) in enumerate(_records(file, at, left, shift)):
                if (one := found[(j := max(0, bisect.bisect_right(cuts, entry[-1]) - 1))]) is None:
                    found[j] = [at, after - at, shift, k]
                else:
                    one[1] = after - one[0]
                at = after
        return [one or [0, 0, 0, 0] for one in found]
    except DAMAGED as e:
        return [str(e)] * len(cuts)


def company_number(entry: str) -> str | None:
    """The third token of names like Prod1_2_01234567_20240331.html."""
    tokens = posixpath.basename(entry).split("_")
    return tokens[2] if len(tokens) > 2 else None


class ZipEntries(DataSource):
    """Entries of zip archives. Options: archives, a JSON list of (path, length); size, bytes of a split; stretches, those known by the split's number in JSON; content, whether contents are read; pushdown, whether the session lets Python sources take filters."""

    @classmethod
    def name(cls) -> str:
        return "zip_entries"

    def schema(self) -> str:
        return ENTRIES

    def reader(self, schema) -> "ZipReader":
        return (FilteringReader if self.options.get("pushdown") == "true" else ZipReader)(self.options)


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.files = [tuple(f) for f in json.loads(options.get("archives", "[]"))]
        self.stretches = json.loads(options.get("stretches", "{}"))
        self.size, self.content, self.only = int(options.get("size", SPLIT)), options.get("content", "false") == "true", None

    def partitions(self) -> list[Split]:
        found = splits(self.files, self.size)
        for one in found:
            one.stretch = self.stretches.get(str(one.number))
        return found

    def read(self, split: Split | None) -> Iterator[tuple]:
        if split is None:
            return
        try:
            with _file(split.path) as file, _file(split.path) as other:
                if isinstance(split.stretch, str):
                    raise zipfile.BadZipFile(split.stretch)
                if split.stretch is None:
                    collections.deque(_directory(file), 0)  # an archive whose directory is damaged gives no entries
                z = _contents(other)
                for k, entry in _numbered(file, split.stretch):
                    if entry[-1] < split.low or (split.high is not None and entry[-1] >= split.high):
                        continue
                    info = _info(entry)
                    number = company_number(info.filename)
                    if not info.is_dir() and (self.only is None or number in self.only):
                        yield split.path, info.filename, number, info.file_size, k, split.number, *(_content(z, info) if self.content else (None, None))
        except DAMAGED as e:
            if not split.low and self.only is None:
                yield split.path, None, None, None, None, split.number, None, f"not an archive: {e}"


def _numbered(file, stretch: list | None) -> Iterator[tuple[int, tuple]]:
    """Ordinals and entries of a stretch of the directory, or of all of it."""
    if stretch is None:
        return enumerate(_directory(file))
    return enumerate((entry for _, entry in _records(file, *stretch[:3])), stretch[3])


class FilteringReader(ZipReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Company numbers are looked for in the directory; other filters are Spark's."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("companynumber",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = wanted if self.only is None else self.only & wanted
            else:
                yield f


def _content(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
    try:
        return z.read(info), None
    except DAMAGED as e:
        return None, str(e)


class Archives:
    """Archives of a listing (path, length), cut into splits for this session's cores."""

    def __init__(self, listing: DataFrame, path: str = "path", length: str = "length", size: int | None = None):
        self.spark = listing.sparkSession
        self.files = sorted({(r[0], r[1]) for r in listing.select(path, length).collect()})  # a row an archive, as any file listing
        total = sum(n for _, n in self.files)
        self.size = size or max(LEAST_SPLIT, min(SPLIT, total // (PER_CORE * self.spark.sparkContext.defaultParallelism)))
        self.count = len(splits(self.files, self.size))

    @functools.cached_property
    def stretches(self) -> dict[int, list | str]:
        """By the split's number, the stretch of each split of archives that have several: a task passes over each one's directory, so that no split has to."""
        cuts: dict[str, list[tuple[int, int]]] = {}
        for one in splits(self.files, self.size):
            cuts.setdefault(one.path, []).append((one.number, one.low))
        many = [(path, [n for n, _ in own], [low for _, low in own]) for path, own in cuts.items() if len(own) > 1]
        if not many:
            return {}

        def run(batches):
            for pdf in batches:
                for path, numbers, lows in pdf.itertuples(index=False):
                    yield pd.DataFrame({"split": list(numbers), "stretch": [json.dumps(x) for x in stretches(path, list(lows))]})

        rows = self.spark.createDataFrame(many, "path string, numbers array<int>, lows array<long>")
        return {r.split: json.loads(r.stretch) for r in rows.repartition(len(many)).mapInPandas(run, "split int, stretch string").collect()}  # a row a split

    def entries(self, content: bool = False) -> DataFrame:
        """archive, entry, companynumber, size, ordinal and split of every entry, with content (bytes) if asked for; `error` says why one has none. An archive that can't be opened is one row without entry."""
        if not self.files:
            return self.spark.createDataFrame([], ENTRIES)
        self.spark.dataSource.register(ZipEntries)
        pushdown = self.spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
        return self.spark.read.format("zip_entries").options(archives=json.dumps(self.files), size=str(self.size), stretches=json.dumps(self.stretches), content=str(content).lower(), pushdown=pushdown).load()

    def read(self, entries: DataFrame) -> DataFrame:
        """The given ones of `entries()` with their content. They go back to their splits, one task for each, whatever joins they went through."""
        if not self.files:
            return entries
        rows = entries.drop("content", "error")
        dealt = rows.repartitionById(self.count, F.col("split")).sortWithinPartitions("archive", "ordinal")
        kinds, known = ", ".join(f"`{c}` {t}" for c, t in dealt.dtypes), self.stretches

        def run(batches):
            z, name, out, size = None, None, [], 0
            for pdf in batches:
                columns = [*pdf.columns, "content", "error"]
                for row in pdf.itertuples(index=False):
                    if row.archive != name:
                        name, z, listed = row.archive, _contents(_file(row.archive)), _numbered(_file(row.archive), known.get(row.split))
                        k, entry = next(listed)
                    while k < row.ordinal:  # rows come in the order of the directory
                        k, entry = next(listed)
                    content, error = _content(z, _info(entry))
                    out.append((*row, content, error))
                    size += len(content or b"")
                    if size >= PIECE:
                        yield pd.DataFrame(out, columns=columns)
                        out, size = [], 0
                if out:
                    yield pd.DataFrame(out, columns=columns)
                    out, size = [], 0

        return dealt.mapInPandas(run, kinds + ", content binary, error string")


# ---------------------------------------------------------------- CSV inside archives

POINTS = "archive string, entry string, method int, data long, packed long, k long, at long, bits int, out long, window binary, inside boolean, clean boolean, next_out long, next_inside boolean, next_clean boolean, header array<string>"


def _data_start(file, info: zipfile.ZipInfo) -> int:
    """Where an entry's data begins: after its own header, name and extra field."""
    file.seek(info.header_offset)
    name, extra = struct.unpack("<HH", file.read(30)[26:30])
    return info.header_offset + 30 + name + extra


class _Quotes:
    """What one pass over a CSV sees: the check sum, whether the place is inside quotes or just after a line, and the first record."""

    def __init__(self):
        self.crc, self.inside, self.clean, self.first, self.known = 0, False, True, b"", False

    def __call__(self, piece: bytes) -> None:
        if not self.known:
            self.first += piece
            end = record_start(self.first, 0, False)
            self.known = end is not None
            self.first = self.first[:end]
        self.crc = zlib.crc32(piece, self.crc)
        if piece:
            self.inside ^= bool(piece.count(b'"') % 2)
            self.clean = not self.inside and piece.endswith(b"\n")


def record_start(text: bytes, at: int, inside: bool) -> int | None:
    """The place after the first line end outside quotes; None if there is none."""
    while True:
        if inside:
            if (at := text.find(b'"', at) + 1) == 0:
                return None
            inside = False
        line = text.find(b"\n", at)
        quote = text.find(b'"', at, line if line >= 0 else len(text))
        if quote < 0:
            return line + 1 if line >= 0 else None
        at, inside = quote + 1, True


def _header(record: bytes) -> list[str]:
    return [h.strip() for h in next(csv.reader(io.StringIO(record.decode("utf-8-sig", "replace"), newline=""), skipinitialspace=True), [])]


def csv_points(archives: Archives, span: int = SPAN) -> DataFrame:
    """Where the CSV files inside archives can be entered, about every `span` bytes of their text; one pass over each file, and 32 KB for each place."""

    def points(path: str, info: zipfile.ZipInfo) -> list[tuple]:
        with _file(path) as file:
            start = _data_start(file, info)
            file.seek(start)
            left, seen, found = info.compress_size, _Quotes(), []

            def read(n: int) -> bytes:
                nonlocal left
                got = file.read(min(n, left))
                left -= len(got)
                return got

            if info.compress_type == zipfile.ZIP_DEFLATED:
                for p in checkpoints(read, span, seen):
                    found.append((p, seen.inside, seen.clean))
            elif info.compress_type == zipfile.ZIP_STORED:
                out = 0
                while True:
                    found.append((Checkpoint(out, 0, out, b""), seen.inside, seen.clean))
                    upto = min(out + span, info.file_size)
                    while out < upto and (piece := read(min(PIECE, upto - out))):
                        seen(piece)
                        out += len(piece)
                    if out >= info.file_size or out < upto:
                        break
            else:
                raise NotImplementedError(f"{path}: {info.filename} is packed in another way than deflate")
        if seen.crc != info.CRC:
            raise zipfile.BadZipFile(f"{path}: {info.filename} is damaged")
        header = _header(seen.first)
        ends = [(p.out, inside, clean) for p, inside, clean in found[1:]] + [(None, None, None)]
        return [(path, info.filename, info.compress_type, start, info.compress_size, k, p.at, p.bits, p.out, p.window, inside, clean, *end, header) for k, ((p, inside, clean), end) in enumerate(zip(found, ends))]

    names = [c.split()[0] for c in POINTS.split(", ")]

    def run(batches):
        for pdf in batches:
            for archive, ordinal in zip(pdf["archive"], pdf["ordinal"]):
                with _file(archive) as file:
                    yield pd.DataFrame(points(archive, _info(next(itertools.islice(_directory(file), ordinal, None)))), columns=names).astype({"next_out": "Int64", "next_inside": "boolean", "next_clean": "boolean"})

    return archives.entries().where(F.lower("entry").endswith(".csv")).select("archive", "ordinal").mapInPandas(run, POINTS)


def _stretch(p) -> bytes:
    """The records that begin between a place and the next one; the last of them may end after that."""
    with _file(p.archive) as file:
        file.seek(p.data + p.at - bool(p.bits))
        before, left = file.read(1)[0] if p.bits else 0, p.packed - p.at

        def read(n: int) -> bytes:
            nonlocal left
            got = file.read(min(n, left))
            left -= len(got)
            return got

        inflater = Inflater(read, Checkpoint(p.at, p.bits, p.out, p.window), before) if p.method == zipfile.ZIP_DEFLATED else None
        pieces, text = iter(inflater or iter(lambda: read(PIECE), b"")), bytearray()
        size = None if pd.isna(p.next_out) else int(p.next_out) - p.out
        try:
            for piece in pieces:
                text += piece
                if size is not None and len(text) >= size:
                    break
            begin = 0 if p.clean else record_start(text, 0, p.inside)
            if begin is None or (size is not None and begin >= size):  # a record that began before runs over all of it
                return b""
            end = size
            if size is not None and not p.next_clean:
                while (end := record_start(text, size, bool(p.next_inside))) is None and (piece := next(pieces, b"")):
                    text += piece
            return bytes(memoryview(text)[begin:end])
        finally:
            if inflater:
                inflater.close()


def read_zipped_csv(archives: Archives, columns: list[str], rows: int = 20_000, span: int = SPAN) -> DataFrame:
    """The given columns, as text, of the CSV files inside archives; a column that a file lacks is NULL, so is an empty field.

    A file is read by a task for each stretch of about `span` bytes. Records end at a line end outside quotes, so quoted
    fields may hold line breaks, also where two stretches meet; the rows are the same for stretches of any length. A damaged file raises an error.
    """
    spark, path = archives.spark, scratch(archives.spark)
    names = [c.replace(".", "_") for c in columns]
    schema = ", ".join(f"`{c}` string" for c in names)
    if not archives.files:
        return spark.createDataFrame([], schema)
    csv_points(archives, span).write.parquet(path)
    points = spark.read.schema(POINTS).parquet(path)
    n = max(1, points.count())
    dealt = points.repartitionById(n, F.pmod(F.hash("archive", "entry").cast("long") + F.col("k"), F.lit(n)).cast("int"))  # neighbours go to different tasks

    def run(batches):
        csv.field_size_limit(1 << 30)
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                header = list(p.header)
                at = [header.index(c) if c in header else -1 for c in columns]
                held, lines = [], csv.reader(io.StringIO(_stretch(p).decode("utf-8-sig" if p.k == 0 else "utf-8", "replace"), newline=""), skipinitialspace=True)
                if p.k == 0:
                    next(lines, None)
                for line in lines:
                    if line:
                        held.append([(line[k] or None) if 0 <= k < len(line) else None for k in at])
                    if len(held) == rows:
                        yield pd.DataFrame(held, columns=names, dtype=object)
                        held = []
                yield pd.DataFrame(held, columns=names, dtype=object)

    return dealt.mapInPandas(run, schema)


class _Spooled:
    """The entries of an archive that is being written, kept in a temporary file until its directory is written."""

    def __init__(self):
        self.file, self.n = tempfile.TemporaryFile(), 0

    def append(self, info: zipfile.ZipInfo) -> None:
        pickle.dump(info, self.file)
        self.n += 1

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[zipfile.ZipInfo]:
        self.file.seek(0)
        for _ in range(self.n):
            yield pickle.load(self.file)
        self.file.close()


class _Written(zipfile.ZipFile):
    """An archive of which only what is in hand stays in memory, however many entries it gets; for one that is written by one process (`write_archives` packs with all tasks)."""

    def __init__(self, out):
        super().__init__(out, "w", zipfile.ZIP_DEFLATED)
        self.filelist = _Spooled()

    def writestr(self, *given) -> None:
        super().writestr(*given)
        self.NameToInfo.clear()


#: An entry's own header.
HEADER = struct.Struct("<4s2B4H3L2H")
#: Bytes of a part of an archive that travel together.
PART = 1 << 20


def _packed(name: str, content: bytes) -> tuple[bytes, bytes]:
    """An entry, and its record for the directory, still without its place. A content has less than 2 GB, as any value of a column."""
    raw, data = name.encode(), zlib.compress(content, wbits=-zlib.MAX_WBITS)
    same = (0 if name.isascii() else 0x800, zipfile.ZIP_DEFLATED, 0, 33, zlib.crc32(content), len(data), len(content), len(raw))  # of 1 January 1980
    return HEADER.pack(b"PK\3\4", 20, 0, *same, 0) + raw + data, ENTRY.pack(b"PK\1\2", 45, 3, 20, 0, *same, 0, 0, 0, 0, 0o600 << 16, 0) + raw


def _placed(records: bytes, places: bytes, base: int) -> Iterator[bytes]:
    """Records with their places: those in the part and the part's place together. Places over 4 GB stand in an extra field."""
    at = 0
    for (place,) in struct.iter_unpack("<Q", places):
        end = at + ENTRY.size + int.from_bytes(records[at + 28 : at + 30], "little")
        if (place := place + base) < 0xFFFFFFFF:
            yield records[at : at + 42] + place.to_bytes(4, "little") + records[at + 46 : end]
        else:
            yield records[at : at + 30] + b"\x0c\0" + records[at + 32 : at + 42] + b"\xff" * 4 + records[at + 46 : end] + struct.pack("<2HQ", 1, 8, place)
        at = end


def _end(n: int, at: int, length: int) -> bytes:
    """What stands after a directory of n records in `length` bytes from `at` on."""
    large = END64.pack(b"PK\6\6", END64.size - 12, 45, 45, 0, 0, n, n, length, at) + PLACE64.pack(b"PK\6\7", 0, at + length, 1) if n >= 0xFFFF or at + length >= 0xFFFFFFFF else b""
    return large + END.pack(b"PK\5\6", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(length, 0xFFFFFFFF), min(at, 0xFFFFFFFF), 0)


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's entries (archive, entry, content), packed: pieces of their archives, and of the directories (with the places in the part)."""
    part, name, k, at = TaskContext.get().partitionId(), None, 0, 0
    packed, records, places = bytearray(), bytearray(), bytearray()

    def pieces(least: int) -> Iterator[pd.DataFrame]:
        nonlocal k
        out = []
        if len(packed) >= least:
            out += [(False, bytes(packed[i : i + PART]), b"") for i in range(0, len(packed), PART)]
            packed.clear()
        if len(records) >= least:
            out.append((True, bytes(records), bytes(places)))
            records.clear()
            places.clear()
        if out:
            yield pd.DataFrame([(name, directory, part, k + i, piece, where) for i, (directory, piece, where) in enumerate(out)], columns=["archive", "directory", "part", "k", "piece", "places"])
            k += len(out)

    for pdf in batches:
        for archive, entry, content in pdf.itertuples(index=False):
            if archive != name:
                yield from pieces(1)
                name, at = archive, 0
            own, record = _packed(entry, content or b"")
            packed += own
            records += record
            places += at.to_bytes(8, "little")
            at += len(own)
            yield from pieces(PART)
    yield from pieces(1)


def write_archives(entries: DataFrame, folder: str) -> DataFrame:
    """Writes archive, entry and content (text or bytes) as zip archives to a shared folder; returns path and number of entries of each.

    Entries are packed by all tasks, in ranges of their order; what is packed goes to one task an archive, which only writes it out one piece
    after the other, under a name of its own that it gives up when complete, so a task may run again.
    """
    rows = entries.select("archive", "entry", F.col("content").cast("binary").alias("content"))
    packed = rows.repartitionByRange("archive", "entry").sortWithinPartitions("archive", "entry").mapInPandas(_parts, "archive string, directory boolean, part int, k int, piece binary, places binary")
    dealt = packed.repartition("archive").sortWithinPartitions("archive", "directory", "part", "k")
    base = folder if ":" in folder else f"file://{folder}"

    def run(batches):
        system, to = fs.FileSystem.from_uri(base)
        system.create_dir(to, recursive=True)
        done, out, name, own, n, at, begin, bases = [], None, None, "", 0, 0, None, {}

        def close():
            out.write(_end(n, at if begin is None else begin, 0 if begin is None else at - begin))
            out.close()
            system.move(own, posixpath.join(to, name))
            done.append((f"{base}/{name}", n))

        for pdf in batches:
            for archive, directory, part, _, piece, places in pdf.itertuples(index=False):
                if archive != name:
                    if out:
                        close()
                    name, n, at, begin, bases, own = archive, 0, 0, None, {}, posixpath.join(to, f".{uuid.uuid4().hex}")
                    out = system.open_output_stream(own)
                bases.setdefault(part, at)
                if directory:
                    begin = at if begin is None else begin
                    n += len(places) // 8
                    piece = b"".join(_placed(piece, places, bases[part]))
                out.write(piece)
                at += len(piece)
        if out:
            close()
        yield pd.DataFrame(done, columns=["path", "entries"])

    return dealt.mapInPandas(run, "path string, entries long")
