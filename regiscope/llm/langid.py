"""Language identification by nearest centroid.

A text is a vector of hashed character n-grams (1 to 3 lower-cased letters, other characters as one
space), weighted by damped count times inverse document frequency and scaled to length one. Each
language has several centroids, found by spherical k-means. A text gets the language of the centroid
with the highest cosine; it is rejected where it has no letter or that cosine is under the floor for its length.

The floors come from all training rows: at most a share `REJECT` of the training rows of about the same number of
letters (powers of two, joined with the next ones up to 1 / `REJECT` rows) is under them. For this a row is
compared with centroids fitted on the other half of the sample only, as on rows they have seen cosines are too high.

Document frequencies are counted over all training rows. The centroids are fitted on at most
`SAMPLE_PER_LANG` distinct rows of each language, taken in the order of a hash of the row.

Null and empty texts and texts without letters are `und` with score 0 and rejected. Training rows with a
null lang are not used. With no training rows every text is `und`. Rows are judged one by one, repeated ones alike;
other columns, whatever their names, are ignored. Texts of any length are counted in pieces.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import first_by_hash, small

DIM = 4096
CLUSTERS = 4
SAMPLE_PER_LANG = 1000
REJECT = 0.002
UNKNOWN = "und"
_CHARS = 1 << 18
_LEVELS, _STEPS = 64, 1000
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


@functools.lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower-case code (32 where it is no letter), and whether it is a letter."""
    letter = np.zeros(0x110000, bool)
    lower = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            low = ch.lower()
            lower[c] = ord(low) if len(low) == 1 else c
    return lower, letter


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (texts x DIM) and number of letters of a few texts."""
    lower, letter = _tables()
    out, letters = np.zeros((len(texts), DIM), np.int64), np.zeros(len(texts), np.int64)
    pieces = [(i, t[at : at + _CHARS + 2 * (at + _CHARS < len(t))]) for i, t in enumerate(texts) for at in range(0, len(t), _CHARS)]
    group, size = [], 0
    for k, (i, t) in enumerate(pieces):
        group.append((i, t))
        size += len(t)
        if size >= _CHARS or k == len(pieces) - 1:
            lens = np.array([len(x) + 2 for _, x in group])
            codes = np.frombuffer("".join(f" {x} " for _, x in group).encode("utf-32-le", "surrogatepass"), np.uint32)
            row = np.repeat(np.array([j for j, _ in group]), lens)
            is_letter = letter[codes]
            letters += np.bincount(row[is_letter], minlength=len(texts))
            c = lower[codes]
            keep = np.ones(len(c), bool)
            keep[1:] = (c[1:] != 32) | (c[:-1] != 32) | (row[1:] != row[:-1])  # each text has its own first and last space
            c, row = c[keep].astype(np.uint32), row[keep]
            a = c * np.uint32(0x9E3779B1)
            b = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + c[1:]
            t3 = (b[:-1] ^ (b[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + c[2:]
            low, high = int(row[0]), int(row[-1]) + 1
            base = (row - low) * DIM
            flat = np.zeros((high - low) * DIM, np.int64)
            for grams in (a, b, t3):
                n = len(grams)
                grams = (grams ^ (grams >> np.uint32(16))) * np.uint32(0x27D4EB2F)
                ok = row[:n] == row[len(row) - n :]
                flat += np.bincount((base[:n] + (grams >> np.uint32(20)))[ok], minlength=len(flat))
            out[low:high] += flat.reshape(-1, DIM)
            group, size = [], 0
    return out, letters


def _slices(texts: list[str], rows: int = 64):
    """Ranges of at most so many texts."""
    for at in range(0, len(texts), rows):
        yield at, texts[at : at + rows]


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all rows each n-gram occurs, and the number of rows."""

    def run(batches):
        df, n = np.zeros(DIM, np.int64), 0
        for b in small(batches, 64):
            for _, part in _slices([t or "" for t in b.column("text").to_pylist()]):
                df += (_counts(part)[0] > 0).sum(axis=0)
                n += len(part)
        yield pa.RecordBatch.from_pydict({"gram": pa.array([*range(DIM), -1], pa.int32()), "n": pa.array([*df, n], pa.int64())})

    got = docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(DIM), 0
    for r in got:
        if r.gram < 0:
            total = r.n
        else:
            out[r.gram] = r.n
    return out, total


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from far apart rows; as many centroids as distinct clusters."""
    centres = [x.mean(axis=0)]
    for _ in range(1, min(k, len(x))):
        near = np.max(x @ np.array([c / max(np.linalg.norm(c), 1e-9) for c in centres]).T, axis=1)
        centres.append(x[int(near.argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def _level(letters: np.ndarray) -> np.ndarray:
    """The power of two of a number of letters."""
    return np.log2(np.maximum(letters, 1)).astype(np.int64)


def _floors(seen: np.ndarray, share: float) -> np.ndarray:
    """For each level of length the cosine that at most a share of the rows is under; seen: rows by level and thousandth.

    A level with too few rows for that share is joined with shorter ones, then with longer ones.
    """
    out, rows = np.zeros(len(seen)), seen.sum(axis=1)
    for k in range(len(seen)):
        low, high = k, k + 1
        while rows[low:high].sum() * share < 1 and (low > 0 or high < len(seen)):
            low, high = (low - 1, high) if low > 0 else (low, high + 1)
        upto = seen[low:high].sum(axis=0).cumsum()
        if upto[-1]:
            out[k] = np.searchsorted(upto, share * upto[-1], "right") / _STEPS
    return out


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floors: np.ndarray | None = None):
        self.idf, self.langs, self.centroids = idf.astype(np.float32), langs, centroids.astype(np.float32)
        self.floors = np.zeros(_LEVELS) if floors is None else floors

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = []
        for _, part in _slices([t or "" for t in texts]):
            counts, letters = _counts(part)
            if not self.langs:
                out += [(UNKNOWN, 0.0, True)] * len(part)
                continue
            cos = _vectors(counts, self.idf) @ self.centroids.T
            best, floor = cos.argmax(axis=1), self.floors[_level(letters)]
            for i, j in enumerate(best):
                score = float(min(1.0, max(0.0, cos[i, j])))
                out.append((self.langs[j], score, bool(score < floor[i])) if letters[i] else (UNKNOWN, 0.0, True))
        return out


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, clusters: int = CLUSTERS) -> Model:
    """docs: doc_id, text, lang of the rows to learn from."""
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    df, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    rows = docs.withColumn("mark", F.xxhash64("doc_id", "text", "lang"))
    picked = first_by_hash(rows, "lang", per_lang).select("mark")
    sample = rows.join(F.broadcast(picked), "mark").dropDuplicates(["mark"]).select("lang", "text", half)  # per_lang marks a language, a row each

    def vectors(batches):
        for b in small(batches, 64):
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows = [v.astype(np.float16).tobytes() for _, part in _slices(texts) for v in _vectors(_counts(part)[0], idf)]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("half"), pa.array(rows, pa.binary())], names=["lang", "half", "v"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        every, of = np.stack([np.frombuffer(v, np.float16) for v in pdf.v]).astype(np.float32), pdf.half.to_numpy()
        out = []
        for part in (0, 1, 2):  # each half, and both
            x = every if part == 2 else every[of == part]
            if len(x):
                out += [(pdf.lang.iloc[0], part, c.astype(np.float32).tobytes()) for c in _kmeans(x[np.lexsort(x[:, :8].T)], clusters)]
        return pd.DataFrame(out, columns=["lang", "part", "v"])

    got = sample.mapInArrow(vectors, "lang string, half int, v binary").groupBy("lang").applyInPandas(fit, "lang string, part int, v binary").collect()
    got.sort(key=lambda r: (r.lang, r.v))
    parts = [np.array([np.frombuffer(r.v, np.float32) for r in got if r.part == k]).reshape(-1, DIM) for k in (0, 1, 2)]
    return Model(idf, [r.lang for r in got if r.part == 2], parts[2], _floors(_cosines(docs.select("text", half), idf, parts), REJECT))


def _cosines(docs: DataFrame, idf: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Numbers of rows with letters by level of length and thousandth of the best cosine to the other half's centroids."""
    shared = docs.sparkSession.sparkContext.broadcast((idf.astype(np.float32), parts))

    def run(batches):
        weights, centroids = shared.value
        seen = np.zeros((_LEVELS, _STEPS + 1), np.int64)
        for b in small(batches, 64):
            halves = b.column("half").to_numpy()
            for at, part in _slices(b.column("text").to_pylist()):
                counts, letters = _counts(part)
                v = _vectors(counts, weights)
                for k in (0, 1):
                    mine = (halves[at : at + len(part)] == k) & (letters > 0)
                    if mine.any() and len(centroids[1 - k]):
                        best = (v[mine] @ centroids[1 - k].T).max(axis=1)
                        np.add.at(seen, (_level(letters[mine]), (np.clip(best, 0, 1) * _STEPS).astype(np.int64)), 1)
        level, step = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(step, pa.int32()), pa.array(seen[level, step], pa.int64())], names=["level", "step", "n"])

    out = np.zeros((_LEVELS, _STEPS + 1), np.int64)
    for r in docs.mapInArrow(run, "level int, step int, n long").groupBy("level", "step").agg(F.sum("n").alias("n")).collect():
        out[r.level, r.step] = r.n
    return out


def identify(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """lang_pred, score and rejected of every row; with `keep`, these columns beside them."""
    names = [doc_id, *(c for c in keep or [] if c != doc_id)]
    docs = documents.select(*names, F.col(text).alias("_text_"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in small(batches, 64):
            got = shared.value.predict(b.column("_text_").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())], names=[*names, "lang_pred", "score", "rejected"])

    from pyspark.sql import types as T

    fields = [docs.schema[c] for c in names]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(run, schema)
