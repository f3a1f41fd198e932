"""Vector codes: each of 8 parts of a vector by its nearest codebook entry, entries found by exact ball k-means on integers.

An entry's parts are its ball: the entry is the centre, the radius the distance of its furthest part. After an entry moved,
another one can only take a part of the ball if it is nearer to the centre than twice the radius (a neighbour); a part that
is nearer to the centre than half the way to the nearest neighbour is in the stable core and keeps its entry without
another distance; the other parts lie in rings between half the ways to the first, second, ... neighbours, and a part of a
ring is compared with the neighbours of that many ways alone. All tests are on squared integers, with equality counted as
possible, so the result is that of comparing everything, ties to the lower index. Balls are taken within a block of rows,
where they are inside the entry's whole ball, so they have the fewer neighbours and no pass is needed for their radii.

Rows are packed to blocks of vectors of about BLOCK bytes once; every round reads the blocks of the round before and writes
its own to the shared folder (codes, sums by entry), and Spark adds the sums up; only the codebooks (8 x 16 entries) meet
in the driver. Kept rows have a vector without null and non-finite components; besides, its length must be a multiple of 8
and that of the first kept row, by vec_id (nulls last), then by vector. Rows with equal ids are rows of their own. With
fewer than 16 rows the codebooks are as many entries long. Components of any finite size are exact (whole numbers without
bound where 64 bits could overflow); an error that no long holds is null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import join_by_count, materialise, release, small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Bytes of the packed vectors of a block.
BLOCK = 1 << 21
#: Largest whole component for 64-bit sums of squares and of rows; beyond it Python's whole numbers are used.
WIDE = 1 << 22
#: Sums go to Spark as digits in this base, so that long sums of digits are exact at any size.
BASE = 10**9
#: Labels up to which their sums are broadcast.
LABELS_BROADCAST = 100_000


def _int_rows(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: int64 where all fit, else Python's whole numbers."""
    with np.errstate(over="ignore"):
        y = np.floor(flat.astype(np.float64) * scale)
    if not len(y) or np.isfinite(y).all() and np.abs(y).max() < WIDE:
        return y.astype(np.int64)
    return np.array([int(v) if np.isfinite(v) else int(x) * scale for v, x in zip(y.tolist(), flat.tolist())], object)  # so large a double is whole


def _pack(rows: np.ndarray) -> bytes:
    """Whole numbers of any size as bytes: the least width of integers that holds them, or text."""
    if rows.dtype == object:
        return b"t" + ",".join(map(str, rows.ravel())).encode()
    for kind in "hiq":
        if not rows.size or np.abs(rows).max() <= np.iinfo(kind).max:
            return kind.encode() + rows.astype(f"<{'i' + str(np.dtype(kind).itemsize)}").tobytes()
    raise OverflowError


def _unpack(raw: bytes, width: int) -> np.ndarray:
    if raw[:1] == b"t":
        return np.array(list(map(int, raw[1:].split(b","))), object).reshape(-1, width)
    return np.frombuffer(raw, f"<i{np.dtype(raw[:1].decode()).itemsize}", offset=1).astype(np.int64).reshape(-1, width)


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of points to entries, row by row or to one."""
    d = points - entries
    return (d * d).sum(axis=-1)


def nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each point by comparing with all."""
    return np.stack([_squares(points, e) for e in entries], axis=1).argmin(axis=1)


def ball_step(points: np.ndarray, entries: np.ndarray, own: np.ndarray, counted: list[int] | None = None) -> np.ndarray:
    """The nearest entry of each point, given any entry of each to start from (best: the nearest before the entries moved)."""
    new = own.copy()
    away = np.stack([_squares(entries, e) for e in entries])
    dist = _squares(points, entries[own])
    for i in range(len(entries)):
        ball = np.flatnonzero(own == i)
        if not len(ball):
            continue
        reach = 4 * dist[ball]  # another entry, at squared distance s from the centre, can be as near only where s <= 4 d
        near = [j for j in sorted(range(len(entries)), key=lambda j: (away[i, j], j)) if j != i and away[i, j] <= reach.max()]  # up to twice the radius
        ways = np.array([away[i, j] for j in near], dtype=away.dtype)
        ring = np.searchsorted(ways, reach, "right") if object not in (ways.dtype, reach.dtype) else np.array([sum(w <= r for w in ways) for r in reach], np.int64)
        if counted is not None:
            counted.append(int(ring.sum()))
        best, at = dist[ball], np.full(len(ball), i)
        for k, j in enumerate(near):
            inside = np.flatnonzero(ring > k)
            d = _squares(points[ball[inside]], entries[j])
            better = (d < best[inside]) | ((d == best[inside]) & (j < at[inside]))
            at[inside[better]], best[inside[better]] = j, d[better]
        new[ball] = at
    return new


def _books(raw: list[list[list[int]]]) -> np.ndarray:
    """Codebooks as an array (part, entry, component)."""
    small_ = all(-WIDE < x < WIDE for part in raw for e in part for x in e)
    return np.array(raw, np.int64 if small_ else object)


def _assign(vectors: np.ndarray, books: list, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances of a block's rows by part."""
    books = _books(books)
    size = books.shape[2]
    out, dist = np.zeros((len(vectors), PARTS), np.int64), []
    for p in range(PARTS):
        part = vectors[:, p * size : (p + 1) * size]
        out[:, p] = nearest(part, books[p]) if codes is None else ball_step(part, books[p], codes[:, p])
        dist.append(_squares(part, books[p][out[:, p]]))
    return out, np.stack(dist, axis=1)


def _digits(x: int) -> list[int]:
    """Digits of a whole number, the lowest first, each with its sign."""
    sign, x, out = -1 if x < 0 else 1, abs(int(x)), []
    while x:
        x, d = divmod(x, BASE)
        out.append(sign * d)
    return out


def _sums(vectors: np.ndarray, codes: np.ndarray, entries: int) -> list[list[int]]:
    """For each part and entry the number of its rows and their sums, as digits."""
    size, out = vectors.shape[1] // PARTS, []
    for p in range(PARTS):
        part = vectors[:, p * size : (p + 1) * size]
        for e in range(entries):
            mine = part[codes[:, p] == e]
            out += map(_digits, [len(mine), *mine.sum(axis=0)] if len(mine) else [0] * (size + 1))
    return out


def _kept(embeddings: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where(F.col("v").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)) & (F.size("v") > 0) & (F.size("v") % PARTS == 0))


def encode(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row."""
    spark = embeddings.sparkSession
    rows = _kept(embeddings, vec_id, vector, label)
    id_type, label_type = rows.schema["vec_id"].dataType, rows.schema["label"].dataType
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # `entries` rows
    out = f"vec_id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error long"
    if not first:
        return _with_labels(spark.createDataFrame([], out), "")
    width = len(first[0].v)
    size = width // PARTS
    seeds = [_int_rows(np.array(r.v), SCALE).tolist() for r in first if len(r.v) == width]
    if len(seeds) < len(first):
        seeds = [_int_rows(np.array(r.v), SCALE).tolist() for r in rows.where(F.size("v") == width).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    books = [[s[p * size : (p + 1) * size] for s in seeds] for p in range(PARTS)]
    per_block = max(1, BLOCK // (8 * width))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, per_block):
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
            lists = [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(c)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([_pack(_int_rows(flat, SCALE))], pa.binary())], names=["ids", "labels", "vectors"])

    def assigned(books: list):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small(batches, 1):
                vectors = _unpack(b.column("vectors")[0].as_py(), width)
                codes = np.frombuffer(b.column("codes")[0].as_py(), np.uint8).reshape(-1, PARTS).astype(np.int64) if "codes" in b.schema.names else None
                codes, _ = _assign(vectors, books, codes)
                cols = [b.column("ids"), b.column("labels"), b.column("vectors"), pa.array([codes.astype(np.uint8).tobytes()], pa.binary()), pa.array([_sums(vectors, codes, len(books[0]))], pa.list_(pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays(cols, names=["ids", "labels", "vectors", "codes", "sums"])

        return run

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            codes = np.frombuffer(b.column("codes")[0].as_py(), np.uint8).reshape(-1, PARTS).astype(np.int64)
            codes, dist = _assign(_unpack(b.column("vectors")[0].as_py(), width), books, codes)
            errors = [e if e < 1 << 63 else None for e in map(int, dist.sum(axis=1))]
            code = [bytes(row).hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column("ids").flatten(), b.column("labels").flatten(), pa.array(code), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    kinds = f"ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, vectors binary"
    blocks = materialise(rows.where(F.size("v") == width).mapInArrow(packed, kinds))
    for _ in range(rounds):
        before = blocks
        blocks = materialise(before.mapInArrow(assigned(books), kinds + ", codes binary, sums array<array<long>>"))
        release(before)
        digits = blocks.select(F.posexplode("sums").alias("at", "s")).select("at", F.posexplode("s").alias("digit", "s")).groupBy("at", "digit").agg(F.sum("s").alias("s"))
        sums = [0] * (PARTS * len(books[0]) * (size + 1))
        for r in digits.collect():  # 8 x 16 x (a part's length + 1) numbers
            sums[r["at"]] += r["s"] * BASE ** r["digit"]
        at = iter(sums)
        for p in range(PARTS):
            for e in range(len(books[p])):
                n, total = next(at), [next(at) for _ in range(size)]
                if n:
                    books[p][e] = [t // n for t in total]
    text = ",".join(str(x) for part in books for e in part for x in e)
    return _with_labels(materialise(blocks.mapInArrow(final, out)), hashlib.sha256(text.encode()).hexdigest())


def _with_labels(coded: DataFrame, books: str) -> DataFrame:
    """Adds the error summed over equal labels (nulls together), and the codebooks' digest."""
    keyed = coded.withColumn("_null", F.col("label").isNull()).withColumn("_label", F.coalesce(F.col("label").cast("string"), F.lit("")))
    sums = keyed.groupBy("_null", "_label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n"))
    if books:
        sums = materialise(sums)
        joined = keyed.join(F.broadcast(sums.drop("n")), ["_null", "_label"]) if sums.count() <= LABELS_BROADCAST else join_by_count(keyed, sums, ["_null", "_label"])
    else:
        joined = keyed.join(sums.drop("n"), ["_null", "_label"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books).alias("codebooks_sha256"))
