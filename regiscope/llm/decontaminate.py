"""Benchmark decontamination by winnowing.

Documents and benchmark items become fingerprints: of each window of `WINDOW` words the smallest hash of `K`
consecutive words in it. A window that a document and an item share has the same fingerprint in both, so joining
fingerprints finds every such window. Windows with the same fingerprint that follow each other are one hit; only hits
are extended to whole windows, which are joined with the items' windows word by word. An item of fewer than `WINDOW`
words is one window, and its fingerprint is the hash of all its words.

The join is one and the same at every size; only who travels differs. Up to `PRINTS` distinct fingerprints of items (8
bytes each) are broadcast as sorted arrays and documents drop other fingerprints where they are read. Beyond that the
documents' hits are dealt by fingerprint. Of equal items and windows one is joined, with the list of its item_ids.

Nulls and empty texts have no words (n_words 0, not contaminated). Items without words have no window. A null item_id
counts as the text `None`. Rows are judged one by one, so repeated rows and ids give repeated results; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import ALNUM, gram_hashes, hash_words, join_by_count, materialise, small, utf8

WINDOW = 13
K = 6
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
PRINTS = 4_000_000
WINDOWS_BROADCAST = 100_000
HITS = "array<struct<size:int,print:long,at:long,words:array<string>>>"
_HITS = pa.list_(pa.struct([("size", pa.int32()), ("print", pa.int64()), ("at", pa.int64()), ("words", pa.list_(pa.string()))]))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of `width` grams, by doubling."""
    low, span = grams, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def fingerprints(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of the window of `size` words at each place of a sequence of word hashes (also across texts)."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    return window_minima(gram_hashes(h, K), WINDOW - K + 1) if size == WINDOW else gram_hashes(h, size)


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_values, x)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == x


def hits(h: np.ndarray, first: np.ndarray, size: int, wanted: np.ndarray | None) -> Iterator[tuple[int, int, int, int]]:
    """(text, place in it, number of windows, fingerprint) of the runs of windows with one fingerprint, of the wanted ones if given."""
    low = fingerprints(h, size)
    at = np.arange(len(low)) if wanted is None else np.flatnonzero(_in(wanted, low))
    text = np.searchsorted(first, at, "right") - 1
    whole = at + size <= first[text + 1]
    at, text = at[whole], text[whole]
    low = low[at]
    starts = np.ones(len(at), bool)
    starts[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(starts)
    yield from zip(text[starts].tolist(), (at - first[text])[starts].tolist(), np.diff(starts, append=len(at)).tolist(), low[starts].view(np.int64).tolist())


def _items(bench: DataFrame) -> DataFrame:
    """item, size (of its windows), words and prints (distinct fingerprints) of each distinct text with words."""
    once = bench.where("text IS NOT NULL").groupBy("text").agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("None")))).alias("items"))

    def run(batches):
        for b in small(batches, 100):
            h, first = hash_words(*utf8(b.column("text")), ALNUM)
            size = np.minimum(WINDOW, np.diff(first))
            prints = [np.unique(fingerprints(h[a:z], int(n))).view(np.int64) if n else [] for a, z, n in zip(first[:-1], first[1:], size)]
            yield pa.RecordBatch.from_arrays([b.column("items"), pa.array(size, pa.int32()), pa.array(map(words_of, b.column("text").to_pylist()), pa.list_(pa.string())), pa.array(prints, pa.list_(pa.int64()))], names=["items", "size", "words", "prints"])

    return materialise(once.mapInArrow(run, "items array<string>, size int, words array<string>, prints array<long>").where("size > 0"))


def _windows(words: str, size: str) -> F.Column:
    """Positions and texts of the windows of `size` words in an array of words."""
    return F.posexplode(F.expr(f"transform(sequence(0, size({words}) - {size}), i -> array_join(slice({words}, i + 1, {size}), ' '))")).alias("ahead", "win")


def _found(docs: DataFrame, sizes: list[int], wanted: dict[int, np.ndarray] | None) -> DataFrame:
    """doc_id, n_words and hits of every row; row tells those with hits apart."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        wanted = shared.value
        for b in small(batches):
            h, first = hash_words(*utf8(b.column("text")), ALNUM)
            found: dict[int, list] = {}
            for size in sizes:
                for text, at, n, low in hits(h, first, size, None if wanted is None else wanted[size]):
                    found.setdefault(text, []).append((size, low, at, n))
            rows, batch = [[] for _ in range(b.num_rows)], uuid.uuid4().hex
            for text, of in found.items():
                words = words_of(b.column("text")[text].as_py())
                rows[text] = [{"size": size, "print": low, "at": at, "words": words[at : at + n + size - 1]} for size, low, at, n in of]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array([f"{batch}-{i}" if r else None for i, r in enumerate(rows)], pa.string()), pa.array(rows, _HITS)], names=["doc_id", "n_words", "row", "hits"])

    return materialise(docs.mapInArrow(run, f"doc_id long, n_words long, row string, hits {HITS}"))


def contamination(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", most_prints: int = PRINTS) -> DataFrame:
    """Per document: words, hit words, items found, the verdict, and the spans of hit words (first and last, from 0)."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = _items(benchmark.select("item_id", "text"))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # 13 at most
    prints = materialise(items.select("size", F.explode("prints").alias("print")).distinct())
    few = prints.count() <= most_prints
    wanted = None
    if few:
        kept = prints.toPandas()
        wanted = {k: np.sort(kept["print"].to_numpy(np.int64)[kept["size"].to_numpy() == k].view(np.uint64)) for k in sizes}
    rows = _found(docs, sizes, wanted)
    hit = rows.where("row IS NOT NULL").select("row", F.explode("hits").alias("h")).select("row", "h.*")
    if not few:  # a print that very many documents have stays where it is
        hit = _spread(hit, prints, ["size", "print"])
    windows = items.select("items", "size", _windows("words", "size")).groupBy("win", "size").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    windows = materialise(windows)
    small_enough = windows.agg(F.count("*"), F.sum(F.length("win") + 20 * F.size("items"))).first()
    asked = hit.select("row", "at", "size", _windows("words", "size")).select("row", (F.col("at") + F.col("ahead")).alias("at"), "size", "win")
    few = small_enough[0] <= WINDOWS_BROADCAST and (small_enough[1] or 0) <= 1 << 25
    met = asked.join(F.broadcast(windows), ["win", "size"]) if few else _spread(materialise(asked), windows, ["win", "size"])
    exact = materialise(met.select("row", "at", (F.col("at") + F.col("size")).alias("to"), "items"))
    return _verdicts(rows, exact)


def _spread(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Join with a table of one row per key, whose keys may be very unequally frequent in df."""
    counted = materialise(df.groupBy(*on).agg(F.count("*").alias("n")).join(table, on))
    return join_by_count(df, counted, on)


def _verdicts(rows: DataFrame, exact: DataFrame) -> DataFrame:
    """exact: row, at, to and items of every window found. Windows of one row are its own words, so a window over them is bounded by its text."""
    w = Window.partitionBy("row").orderBy("at", "to")
    before = exact.select("row", "at", "to").distinct().withColumn("upto", F.coalesce(F.max("to").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
    span = before.withColumn("span", F.sum((F.col("at") > F.col("upto")).cast("int")).over(w)).groupBy("row", "span").agg(F.min("at").alias("first"), (F.max("to") - 1).alias("last"))
    spans = span.groupBy("row").agg(F.sum(F.col("last") - F.col("first") + 1).alias("hit"), F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))
    items = exact.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    found = rows.where("row IS NOT NULL").select("doc_id", "n_words", "row").join(spans, "row", "left").join(items, "row", "left")
    none = rows.where("row IS NULL").select("doc_id", "n_words", F.lit(None).cast("long").alias("hit"), F.lit(None).cast("array<struct<first:long,last:long>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    out = found.select("doc_id", "n_words", "hit", "spans", "items").unionByName(none)
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), F.coalesce("spans", F.array().cast("array<struct<first:long,last:long>>")).alias("spans"))
