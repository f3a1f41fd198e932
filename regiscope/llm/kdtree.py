"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt to cells by a coarse KD split, whose medians come from a bounded sample (at most `SPLIT` vectors and
`SPLIT_BYTES`; it decides only where a vector goes, every vector is dealt), and cells of more than `SHARD` vectors to
shards by a hash. A shard's tree splits at the median of its widest component; nodes carry tight bounding boxes. A block of
queries walks the tree best first by the greatest inner product a box allows and leaves a node once that is under its k-th
score so far. Each query first meets its own shard; the k-th score found there is held against the boxes of all cells,
which are exact, and the query goes only to shards of cells that may still hold a better vector, with that score. A task
holds one shard and at most about `QUERIES` queries: where more come to a shard, they are dealt to blocks, each with a copy
of the shard.

Components become floor(64 * x). Vectors that are null or hold null or non-finite components take no part,
nor do rows with a null id; a shorter vector counts as ending in zeros, an empty one as all zeros. Repeated
ids and rows are rows of their own. Equal scores rank by the smaller id. Other columns, whatever their names, are ignored.
Products are sums of 64-bit floats where the largest component allows none beyond 2^53, else of 64-bit integers, so scores
are exact; components that allow scores beyond 64 bits raise an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import materialise

K = 20
SCALE = 64
SHARD = 8192
QUERIES = 16384
LEAF = 256
BLOCK = 128
CELLS, SPLIT, SPLIT_BYTES = 1024, 20_000, 1 << 25
#: In place of a k-th score where there are fewer.
NO_SCORE = -(1 << 63)
FOUND = "query long, query_id long, row long, vec_id long, score long"


class Tree:
    """Median splits down to LEAF rows; arrays of nodes: box, children or rows."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.child: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self._build(np.arange(len(x)))

    def _build(self, rows: np.ndarray) -> int:
        me, part = len(self.low), self.x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.child.append(None)
        self.rows.append(rows)
        if len(rows) > LEAF and (high > low).any():
            axis = int((high - low).argmax())
            order = rows[np.argsort(part[:, axis], kind="stable")]
            half = len(order) // 2
            self.rows[me] = None
            self.child[me] = (self._build(order[:half]), self._build(order[half:]))
        return me


def _top(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then id, then row."""
    return np.lexsort((rows, ids, -scores))[:k]


def search(tree: Tree, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int):
    """Per query of a block (score, id, row) of what may be among its k best; own: its row, kth: a score that k others reach."""
    best = [(np.zeros(0, q.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q]
    kth, none = kth.copy(), _least(q.dtype)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)

    def bound(node: int) -> np.ndarray:
        return plus @ tree.high[node] + minus @ tree.low[node]

    first = bound(0)
    heap = [(-first.max(), 0, first)]
    while heap:
        _, node, most = heapq.heappop(heap)
        active = np.flatnonzero(most >= kth)
        if not len(active):
            continue
        if tree.child[node] is not None:
            for c in tree.child[node]:
                most = bound(c)
                heapq.heappush(heap, (-most[active].max(), c, most))
            continue
        here = tree.rows[node]
        scores = q[active] @ tree.x[here].T
        scores[own[active][:, None] == rows[here][None, :]] = none
        for a, s in zip(active, scores):
            ok = np.flatnonzero((s >= kth[a]) & (s > none))
            if not len(ok):
                continue
            s0, i0, r0 = best[a]
            s1, i1, r1 = np.concatenate([s0, s[ok]]), np.concatenate([i0, ids[here[ok]]]), np.concatenate([r0, rows[here[ok]]])
            if len(s1) > k:
                keep = _top(s1, i1, r1, k)
                s1, i1, r1 = s1[keep], i1[keep], r1[keep]
            best[a] = (s1, i1, r1)
            if len(s1) >= k:
                kth[a] = max(kth[a], s1.min())
    return best


def _least(kind) -> float | int:
    """Less than any score."""
    return np.iinfo(np.int64).min if kind == np.int64 else -np.inf


def _kind(width: int, top: float):
    """The numbers that hold all scores of such components exactly."""
    most = width * int(top) ** 2
    if most >= 1 << 63:
        raise ValueError("scores of such components do not fit 64 bits")
    return np.float64 if most < 1 << 53 else np.int64


def _kth(column: pd.Series, kind) -> np.ndarray:
    x = column.to_numpy(np.int64)
    return np.where(x == NO_SCORE, _least(kind), x.astype(kind))


def _matrix(column: pd.Series, width: int, kind=np.float64) -> np.ndarray:
    out = np.zeros((len(column), width), kind)
    for row, v in zip(out, column):
        row[: len(v)] = v
    return out


def _visit(k: int, kind):
    def run(key, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        cols: dict[str, list] = {c: [] for c in ("query", "query_id", "row", "vec_id", "score")}
        if len(queries) and len(shard):
            width = max(1, int(max(queries["v"].map(len).max(), shard["v"].map(len).max())))
            shard = shard.sort_values("row")
            tree, ids, rows = Tree(_matrix(shard["v"], width, kind)), shard["vec_id"].to_numpy(), shard["row"].to_numpy()
            queries = queries.sort_values("row")
            for at in range(0, len(queries), BLOCK):
                part = queries.iloc[at : at + BLOCK]
                got = search(tree, ids, rows, _matrix(part["v"], width, kind), part["row"].to_numpy(), _kth(part["kth"], kind), k)
                for q, q_id, (s, i, r) in zip(part["row"], part["vec_id"], got):
                    cols["query"] += [q] * len(s)
                    cols["query_id"] += [q_id] * len(s)
                    cols["row"] += r.tolist()
                    cols["vec_id"] += i.tolist()
                    cols["score"] += s.tolist()
        return pd.DataFrame({c: np.array(v, np.int64) for c, v in cols.items()})

    return run


def vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id and integer components of the vectors that take part, in the shared folder."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    kept = embeddings.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(fine)
    return materialise(kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")))


class Split:
    """A coarse KD split: inner nodes with axis and border, leaves with a number."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.axis, self.border, self.child, self.leaf, self.leaves = [], [], [], [], 0
        self._build(sample, leaves)

    def _build(self, x: np.ndarray, leaves: int) -> int:
        me = len(self.axis)
        for column in (self.axis, self.border, self.child, self.leaf):
            column.append(None)
        spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(1)
        if leaves > 1 and spread.max() > 0:
            axis = int(spread.argmax())
            border = float(np.median(x[:, axis]))
            border = border if (x[:, axis] < border).any() else float(np.nextafter(border, np.inf))  # both sides hold some
            left = x[:, axis] < border
            self.axis[me], self.border[me] = axis, border
            self.child[me] = (self._build(x[left], leaves // 2), self._build(x[~left], leaves - leaves // 2))
        else:
            self.leaf[me], self.leaves = self.leaves, self.leaves + 1
        return me

    def cell(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] is not None:
                out[rows] = self.leaf[node]
                continue
            left = x[rows, self.axis[node]] < self.border[node]
            todo += [(self.child[node][0], rows[left]), (self.child[node][1], rows[~left])]
        return out


def _celled(rows: DataFrame, width: int, shards: int) -> DataFrame:
    """Adds cell, by a split of a sample into as many cells as shards or `CELLS`, whichever is less."""
    cells = min(shards, CELLS, max(1, SPLIT_BYTES // (16 * width)))
    size = min(SPLIT, SPLIT_BYTES // (8 * width))
    picked = rows.orderBy(F.xxhash64("row"), "row").limit(size).select("v").toPandas()  # at most SPLIT_BYTES
    split = rows.sparkSession.sparkContext.broadcast(Split(_matrix(picked["v"], width), cells))

    def run(batches):
        for pdf in batches:
            yield pdf.assign(cell=split.value.cell(_matrix(pdf["v"], width)))

    return rows.mapInPandas(run, "row long, vec_id long, v array<double>, cell long")


def _boxes(rows: DataFrame, width: int) -> pd.DataFrame:
    """cell, n, low and high of every cell: least and greatest components of all its vectors. At most SPLIT_BYTES."""
    packed = "cell long, n long, low array<double>, high array<double>"

    def summed(cell: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
        of, at = np.unique(cell, return_inverse=True)
        lows, highs = np.full((len(of), width), np.inf), np.full((len(of), width), -np.inf)
        np.minimum.at(lows, at, low)
        np.maximum.at(highs, at, high)
        return pd.DataFrame({"cell": of, "n": np.bincount(at, n, len(of)).astype(np.int64), "low": list(lows), "high": list(highs)})

    def partial(batches):
        for pdf in batches:
            x = _matrix(pdf["v"], width)
            yield summed(pdf["cell"].to_numpy(), np.ones(len(x)), x, x)

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return summed(pdf["cell"].to_numpy(), pdf["n"].to_numpy(), np.stack(pdf["low"]), np.stack(pdf["high"]))

    return rows.mapInPandas(partial, packed).groupBy("cell").applyInPandas(whole, packed).toPandas()


def _routed(queries: DataFrame, boxes: pd.DataFrame, width: int) -> DataFrame:
    """Each query once for every other shard of the cells whose box allows its k-th score."""
    kind = _kind(width, max(np.abs(np.stack(boxes[c])).max() for c in ("low", "high")))
    shared = queries.sparkSession.sparkContext.broadcast((np.stack(boxes["low"]).astype(kind), np.stack(boxes["high"]).astype(kind), boxes["cell"].to_numpy(), boxes["shards"].to_numpy()))

    def run(batches):
        low, high, cells, shards = shared.value
        for pdf in batches:
            q = _matrix(pdf["v"], width, kind)
            most = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
            at, box = np.nonzero(most >= _kth(pdf["kth"], kind)[:, None])
            n = shards[box]
            at, cell = np.repeat(at, n), np.repeat(cells[box], n)
            part = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            other = (cell != pdf["cell"].to_numpy()[at]) | (part != pdf["part"].to_numpy()[at])
            for lo in range(0, int(other.sum()), 20_000):
                pick = np.flatnonzero(other)[lo : lo + 20_000]
                yield pdf.iloc[at[pick]].assign(cell=cell[pick], part=part[pick])

    return queries.mapInPandas(run, "row long, vec_id long, v array<double>, kth long, cell long, part long")


def top_k(embeddings: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best other rows."""
    rows = vectors(embeddings)
    count, width, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    width = max(1, width or 0)
    kind = _kind(width, top or 0)
    if not count:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.col("row").alias("score"))
    rows = materialise(_celled(rows, width, -(-count // SHARD)))
    boxes = _boxes(rows, width)
    boxes["shards"] = -(-boxes["n"].to_numpy() // SHARD)
    sizes = F.broadcast(rows.sparkSession.createDataFrame(boxes[["cell", "shards"]]))  # at most CELLS rows
    rows = rows.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("shards"))).drop("shards")
    queries = rows.where(is_query).select(*(F.col(c).alias(c) for c in rows.columns), F.lit(NO_SCORE).alias("kth"))
    near = materialise(queries.groupBy("cell", "part").cogroup(rows.groupBy("cell", "part")).applyInPandas(_visit(k, kind), FOUND))  # a shard's own queries are fewer than its rows
    found = near
    if len(boxes) > 1 or boxes["shards"].max() > 1:
        kth = near.groupBy("query").agg(F.min("score").alias("kth"), F.count("*").alias("n")).select(F.col("query").alias("row"), F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
        far = _routed(queries.drop("kth").join(kth, "row", "left").withColumn("kth", F.coalesce("kth", F.lit(NO_SCORE))).select("row", "vec_id", "v", "kth", "cell", "part"), boxes, width)
        far = materialise(far)
        blocks = far.groupBy("cell", "part").agg(F.ceil(F.count("*") / QUERIES).alias("blocks"))
        blocks = materialise(blocks)
        asked = far.join(blocks, ["cell", "part"]).withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks"))).drop("blocks")
        held = rows.join(blocks.withColumnRenamed("blocks", "copies"), ["cell", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select("cell", "part", "block", "row", "vec_id", "v")
        found = near.unionByName(asked.groupBy("cell", "part", "block").cogroup(held.groupBy("cell", "part", "block")).applyInPandas(_visit(k, kind), FOUND))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
