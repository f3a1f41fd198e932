"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words of the training rows get token labels from the documents' labels: a word is toxic in a toxic
document if it, or how it begins, is far more frequent in toxic documents than in the others: 20 times as frequent, in
`SUPPORT` toxic documents at least, and so often among the documents that hold it that fewer than one of all words tried
would be by chance, given the toxic share of all documents. The number of documents needed so does not grow with the
toxic documents of other languages at the same share. On all windows of words so labelled a two-state chain is fitted (weights of the hashed word, its beginnings of 5 and 7 bytes and its pair
with the word before, and of transitions). Forward-backward marginals of every word of a whole text, computed blockwise
over all texts of a batch as products of 2 x 2 matrices, give offending spans and the document's score:
a logistic function of the expected number of toxic words, the largest marginal and the length.

The model is fitted on at most `SAMPLE` distinct labelled rows of each class with at most `SAMPLE_CHARS` characters each and
`SAMPLE_TOTAL` together, in the order of a hash of doc_id and text; each gives all its words to the counts, and windows around labelled words, and evenly
spread ones, to the chain. Scoring reads text alone and takes a text of any length a stretch of `STRETCH` words at a time.
Null and empty texts have no words and get the score of no evidence. Without labelled rows of both classes every score is
0. Rows are scored one by one, repeated rows alike; rows with a null doc_id are not learned from; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import ALNUM, _MULT, first_by_hash, hash_words, mix, small, utf8

SAMPLE = 3000
SUPPORT = 5
WEIGHTS = 1 << 16
SPAN = 32
STRETCH = 1 << 17
#: Characters of a row that is learned from, and of all rows of a class together.
SAMPLE_CHARS, SAMPLE_TOTAL = 1 << 20, 1 << 25
PREFIXES = (5, 7)
TOXIC_AT = 0.5
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, score double, predicted int, spans array<struct<start:int,end:int>>"


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (words x 3: the word, its first 5 and 7 bytes) and each text's first word."""
    h, first, *heads = hash_words(data, offs, ALNUM, PREFIXES)
    return np.stack([h, *heads], axis=1), first


def _features(h: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places of each word's weights: the word, its beginnings, and the word with the one before it."""
    before = np.zeros(len(h), np.uint64)
    before[1:] = h[:-1, 0]
    before[begins[begins < len(h)]] = np.uint64(0)
    cols = [h[:, 0], h[:, 1], h[:, 2], mix(before * _MULT[3] + h[:, 0])]
    return np.stack([(c >> np.uint64(40)) % np.uint64(WEIGHTS) + np.uint64(i * WEIGHTS) for i, c in enumerate(cols)], axis=1).astype(np.int64)


class Chain:
    """Weights of the two-state chain and of the document score."""

    def __init__(self):
        self.word = np.zeros(4 * WEIGHTS)
        self.trans = np.zeros((2, 2))
        self.bias = -4.0
        self.doc = np.array([-3.0, 1.0, 1.0, 0.0])

    def emission(self, h: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.word[_features(h, begins)].sum(axis=1) + self.bias

    def marginals(self, e: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """P(toxic) of each word of chains that begin at the given places, exactly, in blocks.

        Step i multiplies by M_i = exp(trans) * (1, exp(e_i)); at the start of a chain both rows are
        alike, which cuts the product there. Prefix products within blocks run side by side.
        """
        n = len(e)
        begin = np.zeros(n + 1, bool)
        begin[begins[begins < n]] = True
        begin[n] = True
        p, v, starts = np.empty(n), np.array([1.0, 0.0]), []
        for lo in range(0, n, STRETCH):  # the chain's state at each stretch, so that only one stretch's matrices are held
            starts.append(v)
            if lo + STRETCH < n:
                v = self._last(self._steps(e, begin, lo, lo + STRETCH), v)
        after = np.array([0.5, 0.5])
        for v, lo in zip(reversed(starts), reversed(range(0, n, STRETCH))):
            hi = min(n, lo + STRETCH)
            m = self._steps(e, begin, lo, hi)
            alpha = _scan(m, v)
            # backwards: beta_i = M_{i+1} beta_{i+1}; after a chain's last word it is (1, 1)
            back = np.empty((hi - lo, 2, 2))
            back[-1] = np.eye(2)
            back[:-1] = m[1:]
            back[begin[lo + 1 : hi + 1]] = 0.5
            beta = _scan(back[::-1].transpose(0, 2, 1), after)[::-1]
            after = np.full(2, 0.5) if begin[lo] else m[0] @ beta[0] / (m[0] @ beta[0]).sum()
            both = alpha * beta
            p[lo:hi] = both[:, 1] / both.sum(axis=1)
        return p

    def _steps(self, e: np.ndarray, begin: np.ndarray, lo: int, hi: int) -> np.ndarray:
        t, grow, cut = np.exp(self.trans), np.exp(np.clip(e[lo:hi], -30, 30)), begin[lo:hi]
        m = np.empty((hi - lo, 2, 2))
        m[:, :, 0] = t[:, 0]
        m[:, :, 1] = t[:, 1] * grow[:, None]
        m[cut, :, 0] = 1.0
        m[cut, :, 1] = grow[cut, None]
        return m

    def _last(self, m: np.ndarray, v: np.ndarray) -> np.ndarray:
        """v times all matrices, by pairs."""
        while len(m) > 1:
            if len(m) % 2:
                m = np.concatenate([m, np.eye(2)[None]])
            m = m[::2] @ m[1::2]
            m = m / m.sum(axis=(1, 2), keepdims=True)
        out = v @ m[0]
        return out / out.sum()


def _scan(m: np.ndarray, v: np.ndarray, width: int = 64) -> np.ndarray:
    """v M_0 .. M_i for every i, scaled to sum one: prefix products in blocks side by side, then block by block."""
    n = len(m)
    rows = -(-n // width)
    if rows > 1:
        pad = np.broadcast_to(np.eye(2), (rows * width - n, 2, 2))
        m = np.concatenate([m, pad])
    m = m.reshape(rows, -1, 2, 2)
    out = np.empty_like(m)
    out[:, 0] = m[:, 0]
    for i in range(1, m.shape[1]):
        x = out[:, i - 1] @ m[:, i]
        out[:, i] = x / x.sum(axis=(1, 2), keepdims=True)
    if rows == 1:
        starts = v[None]
    else:
        ends = out[:, -1] / out[:, -1].sum(axis=(1, 2), keepdims=True)
        starts = np.concatenate([v[None], _scan(ends[:-1], v, width)]) if rows > 1 else v[None]
    got = np.einsum("ri,rkij->rkj", starts, out).reshape(-1, 2)[:n]
    return got / got.sum(axis=1, keepdims=True)


def _evidence(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: log(1 + expected toxic words), the largest marginal's log odds, log(1 + words)."""
    n = len(first) - 1
    out = np.zeros((n, 3))
    out[:, 1] = -9.0
    out[:, 2] = np.log1p(np.diff(first))
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        clip = np.clip(p, 1e-4, 1 - 1e-4)
        out[full, 0] = np.log1p(np.add.reduceat(np.where(p > 0.02, p, 0), first[full]))
        top = np.maximum.reduceat(clip, first[full])
        out[full, 1] = np.log(top / (1 - top))
    return out


def _surprising(bad: np.ndarray, good: np.ndarray, share: float) -> np.ndarray:
    """Whether a value's documents are toxic so often that fewer than one of all values tried would be by chance.

    Chernoff's bound of the binomial tail: n documents of which a share x is toxic, `share` of all documents being so.
    """
    n = bad + good
    x = bad / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        far = np.where(bad > 0, x * np.log(x / share), 0.0) + np.where(good > 0, (1 - x) * np.log((1 - x) / (1 - share)), 0.0)
    return (bad >= SUPPORT) & (x > share) & (n * far > np.log(max(1, (n >= SUPPORT).sum())))


def _windows(hot: np.ndarray) -> np.ndarray:
    """Where windows of `SPAN` words begin: evenly over all words, and so that every hot word is in one."""
    clean = np.arange(0, len(hot), max(1, len(hot) // 6000))
    starts = np.unique(np.clip(np.concatenate([np.flatnonzero(hot), clean]) - SPAN // 2, 0, max(0, len(hot) - SPAN)))
    kept = starts[:1].tolist()
    for at in starts.tolist():
        if at - kept[-1] >= SPAN // 2:  # a hot word whose own window goes is in the one before
            kept.append(at)
    return np.unique(np.append(kept, starts[-1:]).astype(np.int64))  # the last one reaches the end


def _fit(pdf: pd.DataFrame) -> Chain:
    """The chain from a bounded table of text and toxic (0 or 1)."""
    chain = Chain()
    pdf = pdf.sort_values(["doc_id", "text"])
    y = pdf["toxic"].to_numpy(int)
    if not (0 < y.sum() < len(y)):
        chain.doc = np.array([-50.0, 0.0, 0.0, 0.0])
        return chain
    data, offs = utf8(pa.array(pdf["text"].fillna("").tolist(), pa.string()))
    h, first = _words(data, offs)
    n1, n0 = y.sum(), len(y) - y.sum()
    where = np.repeat(np.arange(len(y)), np.diff(first))
    hot = np.zeros(len(h), bool)
    for column in range(h.shape[1]):
        values, ids = np.unique(h[:, column], return_inverse=True)
        once = np.unique(ids.astype(np.int64) * len(y) + where)  # a value counts once a document
        ids_once, labels = once // len(y), y[once % len(y)]
        bad, good = (np.bincount(ids_once, labels == k, len(values)) for k in (1, 0))
        odds = np.log((bad + 0.1) / (n1 + 0.2)) - np.log((good + 0.1) / (n0 + 0.2))
        hot |= ((odds > 3) & _surprising(bad, good, n1 / len(y)))[ids]
    label = hot & (y[where] == 1)
    # windows: around labelled words, around the same words in other documents, and some clean text
    starts = _windows(hot)
    size = min(SPAN, len(h))
    place = starts[:, None] + np.arange(size)
    f = _features(h, first[:-1])[place]
    gold = label[place].astype(int)
    _train(chain, f, gold)
    e = chain.emission(h, first[:-1])
    x = np.column_stack([np.ones(len(y)), _evidence(chain.marginals(e, first[:-1]), first)])
    chain.doc = _logistic(x, y)
    return chain


def _train(chain: Chain, f: np.ndarray, gold: np.ndarray, rounds: int = 60, rate: float = 0.3, decay: float = 1e-3, block: int = 20000) -> None:
    """Gradient ascent (Adagrad) on the likelihood of all labelled windows by forward-backward, a block of windows at a time."""
    n = len(gold)
    g_word, g_trans, g_bias = np.full(len(chain.word), 1e-6), np.full((2, 2), 1e-6), 1e-6
    for _ in range(rounds):
        gw, gt, gb = -decay * chain.word / n, np.zeros((2, 2)), 0.0
        for at in range(0, n, block):
            word, trans, bias = _gradient(chain, f[at : at + block], gold[at : at + block])
            gw, gt, gb = gw + word / n, gt + trans / n, gb + bias / n
        g_word += gw**2
        g_trans += gt**2
        g_bias += gb**2
        chain.word += rate * gw / np.sqrt(g_word)
        chain.trans += rate * gt / np.sqrt(g_trans)
        chain.bias += rate * gb / np.sqrt(g_bias)


def _gradient(chain: Chain, f: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the windows' log likelihood by word weights, transitions and bias."""
    size = gold.shape[1]
    e = np.clip(chain.word[f].sum(axis=2) + chain.bias, -30, 30)
    emit = np.stack([np.ones_like(e), np.exp(e)], axis=2)
    t = np.exp(chain.trans)
    a = np.empty_like(emit)
    a[:, 0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for i in range(1, size):
        x = (a[:, i - 1] @ t) * emit[:, i]
        a[:, i] = x / x.sum(axis=1, keepdims=True)
    b = np.empty_like(emit)
    b[:, -1] = 1.0
    pair = np.zeros((2, 2))
    true = np.zeros((2, 2))
    for i in range(size - 2, -1, -1):
        out = emit[:, i + 1] * b[:, i + 1]
        x = a[:, i][:, :, None] * t * out[:, None, :]
        pair += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        np.add.at(true, (gold[:, i], gold[:, i + 1]), 1)
        y = out @ t.T
        b[:, i] = y / y.sum(axis=1, keepdims=True)
    p = a * b
    slack = gold - p[:, :, 1] / p.sum(axis=2)
    return np.bincount(f.reshape(-1), np.repeat(slack.reshape(-1), f.shape[2]), len(chain.word)), true - pair, slack.sum()


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps, the classes weighted alike."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, grad)
    return w


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """documents: doc_id, text; labels: doc_id, toxic; both only of the rows to learn from."""
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = documents.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    sized = rows.select("doc_id", "mark", F.coalesce(F.length("text"), F.lit(0)).alias("size"))
    picked = first_by_hash(sized.join(marked, "doc_id"), "toxic", sample, size="size", total=SAMPLE_TOTAL)
    rows = rows.join(F.broadcast(picked), "mark").dropDuplicates(["mark"]).drop("mark")  # at most 2 * sample marks, a row each
    import pickle

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [pickle.dumps(_fit(pdf))]})

    got = rows.groupBy().applyInPandas(fit, "model binary").collect()
    if not got:
        chain = Chain()
        chain.doc = np.array([-50.0, 0.0, 0.0, 0.0])
        return chain
    return pickle.loads(got[0].model)


def _score(chain: Chain, b: pa.RecordBatch) -> pa.RecordBatch:
    texts = b.column("text")
    data, offs = utf8(texts)
    h, first = _words(data, offs)
    p = np.empty(len(h))
    cuts = [0]
    for k in range(1, len(first)):  # whole texts, together about 2^17 words
        if first[k] - first[cuts[-1]] >= 1 << 17 or k == len(first) - 1:
            lo, hi = first[cuts[-1]], first[k]
            begins = np.unique(first[cuts[-1] : k] - lo)
            p[lo:hi] = chain.marginals(chain.emission(h[lo:hi], begins), begins)
            cuts.append(k)
    x = _evidence(p, first)
    z = chain.doc[0] + x @ chain.doc[1:]
    score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    spans: list[list[dict]] = [[] for _ in range(len(first) - 1)]
    hit = np.flatnonzero(p >= TOXIC_AT)
    for k in np.unique(np.searchsorted(first, hit, "right") - 1).tolist():
        raw = bytes(data[offs[k] : offs[k + 1]])
        found = [m.span() for m in WORD.finditer(raw)]
        for w in hit[(hit >= first[k]) & (hit < first[k + 1])] - first[k]:
            start = len(raw[: found[w][0]].decode("utf-8", "ignore"))
            spans[k].append({"start": start, "end": start + len(raw[found[w][0] : found[w][1]].decode("utf-8", "ignore"))})
    return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["doc_id", "score", "predicted", "spans"])


def score(documents: DataFrame, chain: Chain) -> DataFrame:
    """score, predicted and offending spans (code points, end exclusive) of every text."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = documents.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for b in small(batches):
            if b.num_rows:
                yield _score(shared.value, b)

    return docs.mapInArrow(run, SCHEMA)
