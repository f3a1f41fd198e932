"""Join of documents whose word-shingle sets are similar (Jaccard), by signature trees.

Sets are of 5-word shingles of lower-cased text. Equal sets are one class. To bring similar sets together
without comparing everything, shingles have one global order: first those whose hash lies in a fixed
`SAMPLE` share of the hash range, rare ones first, then the others by hash. Two sets with similarity of
`PERCENT` or more share a shingle among the first n - ceil(n * PERCENT / 100) + 1 of each, so linking every
set with the smallest set that has such a shingle puts them in one block; sets whose early shingles occur
nowhere else need no block. Frequent passages come last in this order and so bind no blocks.

In each block a signature tree holds OR-combined shingle bitmaps and size ranges in its nodes. The tree is traversed
against itself: a pair of nodes is left if its sizes or the greatest overlap its bitmaps allow rule out a link, or if all
their sets are connected already; at the leaves the sets themselves are intersected. Large blocks are first formed again
with every shingle in the order, then cut into parts of about `PART` sets that share a few. What is then not connected with
the block's largest component is compared with all its sets that may be similar by size, in cells of at most about `PART`
by `PART` sets: sets of one block are dealt to bands of size, and only cells of the same or neighbouring bands are made. So
components are exact, no group is expanded into pairs, and no task holds more than a cell at a time.

Shingles travel as packed arrays by ranges of their hash; a range in which one shingle or a few are very frequent is split,
and only its distinct shingles meet. A set is named by a 64-bit digest: of a billion different sets, two share a name with
a chance of one in 37. Null and empty texts and texts without words have an empty set and are linked with nothing; fewer
than 5 words are one shingle. Rows with the same doc_id are judged one by one; a set that only rows without doc_id have is
linked with nothing. Repeated rows are one set. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import SPACED, _MULT, connected_components, gram_hashes, hash_words, join_by_count, materialise, mix, release, small, utf8

WIDTH = 5
PERCENT = 75
SAMPLE = 0.4
PART = 1024
SHARED = 4
BITS = 4096
LEAF = 8
BUCKET = 1_000_000
BLOCKS_BROADCAST = 500_000
META = "doc_id long, n long, m long, s1 long"


def needed(n: int | np.ndarray, percent: int):
    """Least overlap with any similar set."""
    return -(-n * percent // 100)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = hash_words(data, offsets, SPACED)
    grams, out = gram_hashes(words, WIDTH), []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WIDTH:
            out.append(np.unique(grams[a : b - WIDTH + 1]))
        elif b > a:
            out.append(gram_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _name(tokens: np.ndarray) -> int:
    """A 64-bit digest of a set."""
    with np.errstate(over="ignore"):
        a = mix(np.array([np.add.reduce(mix(tokens ^ _MULT[0])) + np.uint64(len(tokens))], np.uint64))
    return int(a.view(np.int64)[0])


def _early(tokens: np.ndarray, percent: int, sample: float) -> tuple[np.ndarray, int]:
    """The shingles that may be among a set's first ones, and how many of them are sampled."""
    keys = mix(tokens)
    keys.sort()
    m = int(np.searchsorted(keys, np.uint64(int(sample * 2**64)))) if sample < 1 else len(keys)
    first = len(tokens) - needed(len(tokens), percent) + 1
    return keys[: max(m, first)], m


def describe(documents: DataFrame, percent: int, buckets: int, sample: float) -> DataFrame:
    """For every text its set's size and name (bucket null), and for every bucket of hashes n early shingles, packed."""

    def run(batches):
        for b in small(batches):
            sets = shingle_sets(*utf8(b.column("text")))
            ids = b.column("doc_id").to_pylist()
            meta, seen, keys, owner = [], {}, [], []
            for i, tokens in zip(ids, sets):
                if not len(tokens):
                    meta.append((i, 0, 0, 0))
                    continue
                name = _name(tokens)
                if (m := seen.get(name)) is None:
                    early, m = _early(tokens, percent, sample)
                    seen[name] = m
                    keys.append(early)
                    owner.append(np.full(len(early), name, np.int64))
                meta.append((i, len(tokens), m, name))
            cols = list(zip(*meta))
            n = len(meta)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=["doc_id", "n", "m", "s1", "bucket", "tokens", "owners"])
            if keys:
                keys, owner = np.concatenate(keys), np.concatenate(owner)
                where = _bucket(keys, buckets)
                order = np.argsort(where, kind="stable")
                keys, owner, where = keys[order], owner[order], where[order]
                cut = np.searchsorted(where, np.arange(buckets + 1))
                full = [k for k in range(buckets) if cut[k] < cut[k + 1]]
                n = len(full)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array([int(cut[k + 1] - cut[k]) for k in full], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(full, pa.int32()),
                    pa.array([_rest(keys[cut[k] : cut[k + 1]]).tobytes() for k in full], pa.binary()), pa.array([owner[cut[k] : cut[k + 1]].tobytes() for k in full], pa.binary())],
                    names=["doc_id", "n", "m", "s1", "bucket", "tokens", "owners"])

    return documents.mapInArrow(run, META + ", bucket int, tokens binary, owners binary")


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int32)


def _rest(keys: np.ndarray) -> np.ndarray:
    """The 32 high bits: in a bucket they tell shingles apart (an equal one only makes a block larger)."""
    return (keys >> np.uint64(32)).astype(np.uint32)


def _unpacked(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (shingle, owner) in that order."""
    tokens = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf.tokens])
    owners = np.concatenate([np.frombuffer(x, np.int64) for x in pdf.owners])
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    return tokens[fresh], owners[fresh]


def _summed(tokens: np.ndarray, hubs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct shingle with its smallest owner and its number of owners."""
    order = np.lexsort((hubs, tokens))
    tokens, hubs, times = tokens[order], hubs[order], times[order]
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
    return tokens[starts], hubs[starts], np.add.reduceat(times, starts) if len(starts) else times


def _partial(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one part of a bucket: its distinct shingles with smallest owner and number of owners, packed."""
    tokens, owners = _unpacked(pdf)
    tokens, hubs, times = _summed(tokens, owners, np.ones(len(tokens), np.int64))
    return pd.DataFrame({"bucket": pdf.bucket.iloc[:1].to_numpy(), "salts": pdf.salts.iloc[:1].to_numpy(), "tokens": [tokens.tobytes()], "hubs": [hubs.tobytes()], "times": [times.tobytes()]})


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the shingles that several of its parts' owners have. An owner that two parts have counts twice, alike for every set."""
    tokens, hubs, times = _summed(*(np.concatenate([np.frombuffer(x, t) for x in pdf[c]]) for c, t in (("tokens", np.uint32), ("hubs", np.int64), ("times", np.int64))))
    keep = times > 1
    return pd.DataFrame({"bucket": pdf.bucket.iloc[:1].to_numpy(), "salts": pdf.salts.iloc[:1].to_numpy(), "tokens": [tokens[keep].tobytes()], "hubs": [hubs[keep].tobytes()], "times": [times[keep].tobytes()]})


def _for_homes(bucket: int, buckets: int, tokens: np.ndarray, owners: np.ndarray, hubs: np.ndarray, times: np.ndarray) -> pd.DataFrame:
    """Shared shingles packed for the sets' own groups."""
    home = _home(owners, buckets)
    order = np.lexsort((owners, home))
    cut = np.searchsorted(home[order], np.arange(buckets + 1))
    full = [k for k in range(buckets) if cut[k] < cut[k + 1]]
    cols = {"owners": owners, "hubs": hubs, "tokens": tokens, "times": np.minimum(times, 0xFFFFFFFF).astype(np.uint32)}
    out = {name: [x[order[cut[k] : cut[k + 1]]].tobytes() for k in full] for name, x in cols.items()}
    return pd.DataFrame({"home": np.array(full, np.int32), "bucket": np.full(len(full), bucket, np.int32), **out})


def _shared(buckets: int):
    """Of one bucket: the shingles that several sets have, packed for the sets' own groups."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, owners = _unpacked(pdf)
        starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        df = np.diff(starts, append=len(tokens))
        hubs, times = np.repeat(owners[starts], df), np.repeat(df, df)
        keep = times > 1
        return _for_homes(pdf.bucket.iloc[0], buckets, tokens[keep], owners[keep], hubs[keep], times[keep])

    return run


def _shared_part(buckets: int):
    """The same of one part of a bucket, given the whole bucket's shared shingles."""

    def run(pdf: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(whole):
            return _for_homes(0, buckets, np.zeros(0, np.uint32), *(np.zeros(0, np.int64) for _ in range(3)))
        tokens, owners = _unpacked(pdf)
        known, hubs, times = (np.frombuffer(whole[c].iloc[0], t) for c, t in (("tokens", np.uint32), ("hubs", np.int64), ("times", np.int64)))
        at = np.searchsorted(known, tokens)
        keep = at < len(known)
        keep[keep] = known[at[keep]] == tokens[keep]
        at = at[keep]
        return _for_homes(pdf.bucket.iloc[0], buckets, tokens[keep], owners[keep], hubs[at], times[at])

    return run


def _shared_shingles(rows: DataFrame, buckets: int) -> DataFrame:
    """rows: bucket, n, tokens, owners. Buckets of many owners are dealt to parts; of these only distinct shingles meet."""
    shape = "home int, bucket int, owners binary, hubs binary, tokens binary, times binary"
    loads = rows.groupBy("bucket").agg(F.ceil(F.sum("n") / (2 * BUCKET)).alias("salts")).where("salts > 2")
    if loads.isEmpty():
        return rows.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_shared(buckets), shape)
    loads = _ids(materialise(loads))
    light = rows.join(loads, "bucket", "left_anti").groupBy("bucket").applyInPandas(_shared(buckets), shape)
    heavy = rows.join(loads, "bucket").withColumn("salt", F.pmod(F.xxhash64("tokens", "owners"), F.col("salts")))
    packed = "bucket int, salts long, tokens binary, hubs binary, times binary"
    whole = materialise(heavy.groupBy("bucket", "salt").applyInPandas(_partial, packed).groupBy("bucket").applyInPandas(_joined, packed))
    dealt = whole.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    parts = heavy.groupBy("bucket", "salt").cogroup(dealt.groupBy("bucket", "salt")).applyInPandas(_shared_part(buckets), shape)
    return light.unionByName(parts)


def _home(owners: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(owners.view(np.uint64) * _MULT[2]) % np.uint64(buckets)).astype(np.int32)


def _links(percent: int, sample: float):
    """Of the sets of one group: links with the smallest sets that share one of their first shingles."""
    sampled = int(sample * 2**32)

    def run(key, shared: pd.DataFrame, meta: pd.DataFrame) -> pd.DataFrame:
        if not len(shared) or not len(meta):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        cols = {c: np.concatenate([np.frombuffer(x, t) for x in shared[c]]) for c, t in (("owners", np.int64), ("hubs", np.int64), ("tokens", np.uint32), ("times", np.uint32))}
        bucket = np.repeat(shared.bucket.to_numpy(), [len(x) // 8 for x in shared.owners])
        meta = meta.drop_duplicates("s1").sort_values("s1")
        at = np.searchsorted(meta.s1.to_numpy(), cols["owners"])
        n, m = meta.n.to_numpy()[at], meta.m.to_numpy()[at]
        late = cols["tokens"].astype(np.int64) >= sampled  # these come after all sampled ones, by hash
        rare = np.where(late, 0, cols["times"])
        order = np.lexsort((bucket, cols["tokens"], rare, late, cols["owners"]))
        owners, hubs, n, m, late = cols["owners"][order], cols["hubs"][order], n[order], m[order], late[order]
        starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        count = np.diff(starts, append=len(owners))
        early = np.repeat(np.add.reduceat((~late).astype(np.int64), starts), count)
        rank = np.arange(len(owners)) - np.repeat(starts, count)
        first = n - needed(n, percent) + 1
        use = late | (rank < first - (m - early))  # m - early sampled shingles occur in no other set and come first
        pairs = np.unique(np.stack([owners[use], hubs[use]], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


# ---------------------------------------------------------------- signature trees

class Tree:
    """Sets in the order of size, and nodes of LEAF children: OR of bitmaps, sizes from and to, most tokens beyond bits."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        size = np.array([len(s) for s in sets])
        bits = np.zeros((len(sets), BITS), bool)
        for row, s in zip(bits, sets):
            row[(s % np.uint64(BITS)).astype(np.int64)] = True
        bitmap = np.packbits(bits, axis=1).view(np.uint64)
        over = size - bits.sum(axis=1)
        self.levels = [(bitmap, size, size, over)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, ov = self.levels[-1]
            cut = np.arange(0, len(b), LEAF)
            self.levels.append((np.bitwise_or.reduceat(b, cut), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(ov, cut)))


def tree_links(sets: list[np.ndarray], probes: list[int] | None, percent: int, group: list[int] | None = None) -> list[tuple[int, int]]:
    """Links (places in sets) that connect what is connected; only pairs with a probe if probes are given; group: known components."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    tree = Tree([sets[i] for i in order])
    top = len(tree.levels) - 1
    parent = list(range(len(sets)))
    seen: dict[int, int] = {}
    if group is not None:
        for i, j in enumerate(order):
            parent[i] = seen.setdefault(group[j], i)
    is_probe = None if probes is None else np.isin(order, probes)
    found = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def same(level: int, x: int, y: int) -> bool:
        step = LEAF**level
        r = root(x * step)
        return all(root(i) == r for node in (x, y) for i in range(node * step, min(len(sets), (node + 1) * step)))

    stack = [(top, 0, 0)]
    while stack:
        level, x, y = stack.pop()
        bitmap, lo, hi, over = tree.levels[level]
        if level == 0:
            if x == y or root(x) == root(y) or (is_probe is not None and not (is_probe[x] or is_probe[y])):
                continue
            a, b = tree.sets[x], tree.sets[y]
            common = len(a) + len(b) - len(np.union1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                parent[root(x)] = root(y)
                found.append((order[x], order[y]))
            continue
        step = LEAF ** (level - 1)
        down, dlo, dhi, dover = tree.levels[level - 1]
        xs = np.arange(x * LEAF, min(len(down), (x + 1) * LEAF))
        ys = xs if x == y else np.arange(y * LEAF, min(len(down), (y + 1) * LEAF))
        fits = (100 * dhi[xs][:, None] >= percent * dlo[ys][None, :]) & (100 * dhi[ys][None, :] >= percent * dlo[xs][:, None])
        overlap = np.bitwise_count(down[xs][:, None, :] & down[ys][None, :, :]).sum(axis=2) + np.minimum(dover[xs][:, None], dover[ys][None, :])
        fits &= (100 + percent) * overlap >= percent * (dlo[xs][:, None] + dlo[ys][None, :])
        nodes = [(level - 1, int(xs[i]), int(ys[j])) for i, j in zip(*np.nonzero(fits)) if x != y or i <= j]
        stack += sorted((p for p in nodes if level == 1 or not same(*p)), key=lambda p: p[1] == p[2])
    return found


def _block_links(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        for _, block in pdf.groupby("cell", sort=False):
            # a set may be both a cell's member and its probe
            block = block.sort_values("probe", ascending=False).drop_duplicates("s1").sort_values("s1")
            if len(block) < 2:
                continue
            names = block.s1.tolist()
            sets = [np.frombuffer(x, np.uint64) for x in block.tokens]
            probe = block.probe.to_numpy()
            for x, y in tree_links(sets, np.flatnonzero(probe).tolist() if probe.any() else None, percent, block["group"].tolist() if block["group"].notna().all() else None):
                a.append(names[x])
                b.append(names[y])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def _blocks(docs: DataFrame, percent: int, sample: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """meta (a row per document), sets (s1, n, m, of: a doc_id that has it), blocks (s1, block) of the sets that may be similar to others."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(max(16, chars // 8 // BUCKET + 1))
    described = materialise(describe(docs, percent, buckets, sample))
    meta = described.where("bucket IS NULL").select("doc_id", "n", "m", "s1")
    sets = meta.where("n > 0").groupBy("s1").agg(F.min("n").alias("n"), F.min("m").alias("m"), F.min("doc_id").alias("of"))

    def home(column: pd.Series) -> pd.Series:
        return pd.Series(_home(column.to_numpy(np.int64), buckets))

    homed = sets.withColumn("home", F.pandas_udf(home, "int")("s1")).select("home", "s1", "n", "m")
    shared = _shared_shingles(described.where("bucket IS NOT NULL").select("bucket", "n", "tokens", "owners"), buckets)
    # written, as stars are made in Python too: a task would take two workers, and both stay
    links = materialise(shared.groupBy("home").cogroup(homed.groupBy("home")).applyInPandas(_links(percent, sample), "a long, b long"))
    blocks = materialise(connected_components(links).select(F.col("node").alias("s1"), F.col("label").alias("block")))
    release(links)
    return meta, sets, blocks


def _ids(df: DataFrame, limit: int = BLOCKS_BROADCAST) -> DataFrame:
    """For a join with the texts: broadcast while it has few rows."""
    return F.broadcast(df) if df.count() <= limit else df


def _few(df: DataFrame, rows: int) -> DataFrame:
    """For a join: broadcast where at most so many rows are known to be few."""
    return F.broadcast(df) if rows <= BLOCKS_BROADCAST else df


def _compare(docs: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in each cell. placed: of, s1, cells, probe, group (null: not known)."""

    def tokens(batches):
        for b in small(batches):
            found = shingle_sets(*utf8(b.column("text")))
            # another row may have the same doc_id and another text
            t = [x.tobytes() if len(x) and _name(x) == s1 else None for x, s1 in zip(found, b.column("s1").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(t, pa.binary())], names=[*names, "tokens"])

    names = ["s1", "cells", "probe", "group"]
    rows, cells = placed.agg(F.count("*"), F.sum(F.size("cells"))).first()
    texts = docs.join(_few(placed.withColumnRenamed("of", "doc_id"), rows), "doc_id").select("text", *names)
    full = texts.mapInArrow(tokens, "s1 long, cells array<long>, probe boolean, group long, tokens binary").where("tokens IS NOT NULL")
    packs = max(8, -(-(cells or 0) // PART))
    dealt = full.withColumn("cell", F.explode("cells")).withColumn("pack", F.pmod("cell", F.lit(packs)))
    return materialise(dealt.select("pack", "cell", "s1", "tokens", "probe", "group").groupBy("pack").applyInPandas(_block_links(percent), "a long, b long"))


def _cells(of: DataFrame, percent: int, large: int) -> DataFrame:
    """of, with so many blocks: of, s1, n, block, group, probe. Deals each block's probes and all its sets to cells of at most about PART by PART sets.

    A band holds sizes within a factor of 100 / percent, so similar sets are in the same or neighbouring bands. A pair of a
    probe and a set meets in the cell of the probe's share of its band and the set's share of its band.
    """
    of = materialise(of.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.001 / percent))).cast("long")))
    bands = of.groupBy("block", "band").agg(F.ceil(F.count("*") / PART).alias("shares"), F.ceil(F.count_if("probe") / PART).alias("chunks"))
    near = bands.where("chunks > 0").select("block", F.col("band").alias("of_probe"), "chunks", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    near = _few(near.join(bands.select("block", "band", "shares"), ["block", "band"]), 200 * large)  # sizes up to 2^27 have under 67 bands, each with three rows
    cell = lambda share, chunk: F.xxhash64("block", "band", "of_probe", share, chunk)
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    share, chunk = F.pmod(F.xxhash64("s1"), F.col("shares")), F.pmod(F.xxhash64("s1", F.lit(1)), F.col("chunks"))
    member = of.join(near, ["block", "band"]).withColumn("share", share).withColumn("cell", F.explode(F.transform(upto("chunks"), lambda j: cell(F.col("share"), j))))
    probes = of.where("probe").withColumnRenamed("band", "of_probe").join(near, ["block", "of_probe"]).withColumn("chunk", chunk).withColumn("cell", F.explode(F.transform(upto("shares"), lambda i: cell(i, F.col("chunk")))))
    both = member.select("of", "s1", "group", F.lit(False).alias("probe"), "cell").unionByName(probes.select("of", "s1", "group", "probe", "cell"))
    return materialise(both.groupBy("of", "s1", "group", "probe").agg(F.collect_list("cell").alias("cells")))


def similar_sets(documents: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(meta: doc_id, n, s1 (name of the set) of every row; links: a, b names of sets, enough to connect what is connected)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    meta, sets, blocks = _blocks(docs, percent, SAMPLE)

    def sized(blocks: DataFrame) -> tuple[DataFrame, int]:
        """s1, block, size (1 if not large), of, n, own (a part) and every (part) of each set, and the number of large blocks."""
        large = materialise(blocks.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > PART))
        many = large.count()
        all_ = blocks.join(_few(large, many), "block", "left").withColumn("size", F.coalesce("size", F.lit(1))).join(sets.select("s1", "of", "n"), "s1")
        count = F.ceil(F.col("size") / PART).cast("long")
        return materialise(all_.withColumn("own", F.pmod(F.xxhash64("s1"), count)).withColumn("every", F.sequence(F.lit(0).cast("long"), count - 1))), many

    placed, many = sized(blocks)
    if many:  # again with all shingles of these sets in order, which parts what only frequent passages joined
        large = placed.where(F.col("size") > PART)
        of = _ids(materialise(large.select(F.col("of").alias("doc_id")).distinct()))
        _, _, finer = _blocks(docs.join(of, "doc_id", "left_semi"), percent, 1.0)
        finer, many = sized(finer.join(large.select("s1"), "s1", "left_semi"))
        placed = placed.where(F.col("size") <= PART).unionByName(finer)
    large = placed.where(F.col("size") > PART)
    some = large.groupBy("block", "own").agg(F.min("s1").alias("s1"))  # a set for each part
    hubs = some.withColumn("k", F.row_number().over(Window.partitionBy("block").orderBy("s1"))).where(F.col("k") <= SHARED).select("s1", F.lit(True).alias("hub"))
    parts = F.when(F.col("hub"), F.col("every")).otherwise(F.array("own"))
    plain = placed.join(_few(hubs, SHARED * many), "s1", "left") if many else placed.withColumn("hub", F.lit(False))
    plain = plain.select("of", "s1", F.transform(parts, lambda p: F.xxhash64("block", p)).alias("cells"), F.lit(False).alias("probe"), F.lit(None).cast("long").alias("group"))
    found = _compare(docs, materialise(plain), percent)
    if many:
        known = materialise(connected_components(found))
        of = large.join(known, large.s1 == known.node, "left").withColumn("group", F.coalesce("label", "s1")).select("of", "s1", "n", "block", "group")
        main = of.groupBy("block", "group").agg(F.count("*").alias("size")).groupBy("block").agg(F.max_by("group", F.struct("size", "group")).alias("main"))
        of = of.join(_few(main, many), "block").withColumn("probe", F.col("group") != F.col("main")).drop("main")
        again = _cells(of, percent, many)
        found = known.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))  # as stars, which need few rounds
        if not again.isEmpty():
            found = found.unionByName(_compare(docs, again, percent))
    return meta, found


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with an equal set) and component_id of every row."""
    meta, links = similar_sets(documents, percent)
    labels = materialise(connected_components(links)).withColumnRenamed("node", "s1")
    sets = meta.where("n > 0").groupBy("s1").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("rows"))
    sets = materialise(sets.join(labels, "s1", "left").withColumn("label", F.coalesce("label", "s1")))
    least = materialise(sets.groupBy("label").agg(F.min("class_id").alias("component_id"), F.count("*").alias("sets")))
    sets = materialise(join_by_count(sets, least, ["label"], count="sets").drop("label"))
    out = join_by_count(meta.where("n > 0").select("doc_id", "n", "s1"), sets, ["s1"], count="rows")
    none = meta.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id").unionByName(none)
