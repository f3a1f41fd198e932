"""Shared helpers: shared-folder tables, Arrow text access, vectorised word hashing, connected components."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Text is worked on in pieces of about so many bytes, so memory does not follow the batch size.
PIECE = 1 << 19


#: Rows and bytes of a batch that are worked on together; a row of more bytes goes by itself.
ROWS, BYTES = 1000, 1 << 22
#: Most keys that `join_by_count` broadcasts, and the fewest rows that make a key one of them.
HEAVY_KEYS, HEAVY_ROWS = 100_000, 10_000
#: Edges (16 bytes each) that a task takes at once; a graph of no more needs no rounds of shuffles.
EDGES = 1 << 17


@functools.cache
def _libc():
    """The C library of a Python worker; glibc is told there that arrays from 4 MB on go back to the system when freed (M_MMAP_THRESHOLD)."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 1 << 22)
    return libc


def give_back() -> None:
    """Hand memory that is free back to the system: Python workers stay for later stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc(), "malloc_trim"):  # glibc
        _libc().malloc_trim(0)


#: What operators keep in a Python worker from task to task, and how it is forgotten.
_KEPT: dict[str, Callable[[], object]] = {}


def keeps(owner: str, forget: Callable[[], object]) -> None:
    """Says that an operator keeps things in its workers: when another one starts in the same worker, they go."""
    _KEPT[owner] = forget


def small(batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = BYTES, owner: str = "") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to so many rows and bytes of text (without copying), as working arrays are several times as large as the text. For Python workers."""
    _libc()
    for name, forget in _KEPT.items():
        if name != owner:
            forget()
    for b in batches:
        ends = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                ends += pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False)
        ends = ends.cumsum()
        at = 0
        while at < b.num_rows:
            fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
            to = min(at + rows, max(fits, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to
        del b
    give_back()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); where none is set, a temporary one in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="regiscope-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def in_small_batches(df: DataFrame) -> DataFrame:
    """df as a table of a session of its own, with the caller's settings but for the size of Arrow batches: at most ROWS rows or about BYTES bytes.

    Outside the JVM's heap a task holds a batch three times or more, and its Python worker once. The caller's session stays as it is;
    what is made from the table belongs to the other session, and `materialise` brings it back.
    """
    spark, name = df.sparkSession, f"regiscope_{uuid.uuid4().hex}"
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(ROWS, rows) if rows > 0 else ROWS))
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES))
    df.withColumn(name, F.lit(0)).createGlobalTempView(name)  # with a column of its own it is no plan that the caller has cached, which would go with the view
    try:
        return own.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}").drop(name)
    finally:
        spark.catalog.dropGlobalTempView(name)


def materialise(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Write df to the shared folder once and read it back, by another session if one is given: cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/regiscope-{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    out = (spark or df.sparkSession).read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of `materialise` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def join_by_count(df: DataFrame, table: DataFrame, on: list[str], how: str = "inner", count: str = "n") -> DataFrame:
    """Inner or left join of df with a table of one row per key that also has the key's rows in df.

    Keys with many rows are broadcast, at most `HEAVY_KEYS` of them, so their rows stay where they are; the others are dealt
    by key. df is then read twice; where no key has many rows, once.
    """
    rows, most = table.agg(F.sum(count), F.max(count)).first()
    least = max(HEAVY_ROWS, (rows or 0) // HEAVY_KEYS)
    if (most or 0) <= least:
        return df.join(table.drop(count), on, how)
    heavy = F.broadcast(table.where(F.col(count) > least).drop(count))
    light = table.where(F.col(count) <= least).drop(count)
    return df.join(heavy, on).unionByName(df.join(heavy.select(*on), on, "left_anti").join(light, on, how), allowMissingColumns=True)


def first_by_hash(df: DataFrame, group: str, n: int, mark: str = "mark", size: str | None = None, total: int = 0) -> DataFrame:
    """At most n rows of each group: those with the smallest `mark`, a 64-bit hash, one row for each mark.

    With `size`, only as many of these as have `total` of it together in the order of the hash, and the first in any case.
    Rows are counted by 2^16 ranges of the hash, and only those up to the range that holds the n-th are ranked, so no task
    gets a whole group. The groups are few (labels, languages).
    """
    names = [group, mark] + ([size] if size else [])
    rows = df.select(*names).distinct().withColumn("_range", F.shiftright(mark, 48))
    upto = Window.partitionBy(group).orderBy("_range")
    counts = rows.groupBy(group, "_range").agg(F.count("*").alias("_n")).withColumn("_to", F.sum("_n").over(upto))
    last = counts.where(F.col("_to") - F.col("_n") < n).groupBy(group).agg(F.max("_range").alias("_last"))
    near = rows.join(F.broadcast(last), group).where("_range <= _last")
    w = Window.partitionBy(group).orderBy(mark)
    ranked = near.withColumn("_k", F.row_number().over(w))
    if size:
        ranked = ranked.withColumn("_sum", F.sum(F.col(size).cast("long")).over(w)).where((F.col("_sum") <= total) | (F.col("_k") == 1))
    return ranked.where(F.col("_k") <= n).select(group, mark)


def is_set(column) -> "F.Column":
    """1 where the column is true, else 0 (null counts as false)."""
    return F.coalesce(column.cast("int"), F.lit(0))


# ---------------------------------------------------------------- hashing of words in Arrow buffers

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of lower-cased text: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of lower-cased text: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its len + 1 offsets; nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about PIECE that never divide a word."""
    at, end = 0, len(data)
    while at < end:
        to = min(end, at + PIECE)
        if to < end:
            k = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:
                while to < end and word[data[to]] and word[data[to - 1]]:
                    to += 1
        yield at, to
        at = to


def hash_words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the lower-cased words of all texts in order, and each text's first word (len + 1 offsets).

    With prefixes, also an array of hashes for each: of that many first bytes, or of the whole shorter word.
    """
    hashes, places = [], []
    heads: list[list[np.ndarray]] = [[] for _ in prefixes]
    for lo, hi in _cuts(data, offsets, word):
        part = data[lo:hi]
        m = word[part]
        first = m.copy()
        first[1:] &= ~m[:-1]
        edge = offsets[(offsets >= lo) & (offsets < hi)] - lo
        first[edge] = m[edge]
        low = LOWER[part[m]]
        starts = np.flatnonzero(first[m])
        if not len(starts):
            continue
        lens = np.diff(starts, append=len(low))
        power = np.full(int(lens.max()), _BASE)
        power[0] = 1
        np.cumprod(power, out=power)
        pos = np.arange(len(low)) - np.repeat(starts, lens)
        terms = _BYTE[low] * power[pos]
        hashes.append(mix(np.add.reduceat(terms, starts) + lens.astype(np.uint64)))
        for k, out in zip(prefixes, heads):
            out.append(mix(np.add.reduceat(np.where(pos < k, terms, np.uint64(0)), starts) + np.uint64(k << 32)))
        places.append(np.flatnonzero(first) + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), *(np.zeros(0, np.uint64) for _ in prefixes)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets), *map(np.concatenate, heads)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place (len - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n] * _MULT[0]
    for j in range(1, k):
        h = h + words[j : j + n] * _MULT[j]
    return mix(h + np.uint64(k))


# ---------------------------------------------------------------- connected components

def _all_stars(e: DataFrame) -> bool:
    """Whether every edge leads from a smallest node to a node that has no other edge."""
    ends = e.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("lo", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max(is_set(F.expr("up > 1 OR (up = 1 AND down = 1)")))).first()[0]


def smallest_linked(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of some edges: each node that is not its component's smallest, and that smallest one."""
    nodes, at = np.unique(np.concatenate([lo, hi]), return_inverse=True)
    a, b = at[: len(lo)], at[len(lo) :]
    label = np.arange(len(nodes))
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (lo, hi) as stars, `EDGES` at a time at least: they connect what the edges connect."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        hi, lo = smallest_linked(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(lo), pa.array(hi)], names=["lo", "hi"])

    for b in batches:
        held.append((b.column("lo").to_numpy(), b.column("hi").to_numpy()))
        n += b.num_rows
        if n > EDGES:
            yield out()
            held, n = [], 0
    if held:
        yield out()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the edges; label is the component's smallest node.

    Every task first makes stars of the edges that it has. More than `EDGES` then left, they go through alternating
    large-star and small-star steps on DataFrames, until all components are stars: each is a grouped minimum
    (combined before the shuffle) and a join of the edges with one row per node, so a hub is never gathered in one
    task. As soon as no more than `EDGES` are left, which is no more than one task's share, a task ends it without
    further steps. Every step is written to the shared folder.
    """
    e = edges.select(F.least(a, b).cast("long").alias("lo"), F.greatest(a, b).cast("long").alias("hi")).where("lo < hi")
    e = materialise(e.mapInArrow(_stars, "lo long, hi long"))
    while True:
        before = e
        if e.count() <= EDGES:
            e = materialise(e.coalesce(1).mapInArrow(_stars, "lo long, hi long"))
            release(before)
            break
        if _all_stars(e):
            break
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(e.select("hi", "lo"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        small = small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).union(low.select("m", "hi")).where("lo < hi").distinct()
        e = materialise(small)
        release(before)
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(e.select("lo", "lo").distinct())
