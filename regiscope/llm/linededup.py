"""Deletion of later copies of repeated runs of lines, by a suffix array over line IDs.

Documents in the order of (doc_id, hash of text) are sequences of line IDs over their lines that are not blank. Lines
that occur once end a run; the suffixes at all other lines are sorted by prefix doubling: level k holds the suffixes whose
first 2^k lines occur more than once, each with the interval of the suffix array that they form (its start `rank`, its
length `n`, in the order of line IDs), and the next level sorts the pairs of the ranks of both halves. Only distinct pairs
are sorted, by ranges, and a pair's start is the number of suffixes with smaller pairs. An interval is a
longest-common-prefix interval: its suffixes, and no others, share that many lines.

A repeated run counts if it has `min_words` words. The shortest such run from each line on and up to each line is looked
up as the interval of suffixes that share it (the ranks of its first and its last 2^k lines name the interval); together
these cover all lines of every maximal repeated run. The smallest position in an interval is the first copy, and the lines
of all others are deleted. The number of doublings depends on `min_words` alone.

Null and empty texts stay as they are (0 lines). Rows equal in doc_id and text are one position: neither is a later copy
of the other. A null doc_id comes before all others. Other columns stay, whatever their names, but for `n_lines` and
`n_removed`, whose names can be chosen. Repeated runs of fewer words stay by design.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.llm.common import join_by_count, materialise, release

MIN_WORDS = 50
BROADCAST_LINES = 2_000_000


def _row_key(doc_id: str = "doc_id", text: str = "text") -> F.Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def _lines(documents: DataFrame) -> DataFrame:
    """key, doc_id, line (number), o (number among lines that aren't blank), two hashes and words of each line."""
    line = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit(7)).alias("h2"),
                       F.size(F.filter(F.split(x, r"\s+"), lambda w: w != "")).alias("w")))
    rows = documents.where("text IS NOT NULL").select("doc_id", _row_key().alias("key"), F.posexplode(F.filter(line, lambda x: x.w > 0)).alias("o", "x"))
    return rows.select("doc_id", "key", "o", "x.*").distinct()


def _starts(pairs: DataFrame, on: list[str]) -> DataFrame:
    """Adds rank to a table of distinct pairs with their number n: how many suffixes have smaller pairs.

    Pairs are sorted by ranges; a range's sum goes before the next ones (as many rows as partitions), so no task holds all.
    """
    dealt = materialise(pairs.repartitionByRange(*on).sortWithinPartitions(*on).withColumn("_range", F.spark_partition_id()))
    whole = Window.partitionBy("_range").orderBy(*on).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range").agg(F.sum("n").alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    return dealt.join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + F.coalesce(F.sum("n").over(whole), F.lit(0))).drop("_range", "_before")


def _active(lines: DataFrame) -> tuple[DataFrame, int]:
    """Positions of lines that occur more than once, and their number.

    at (in document order, consecutive in a run), run, key, line, w, and the interval of suffixes that begin with this line: rank, n, low.
    """
    twice = _starts(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1"), ["h1", "h2"])
    twice = materialise(twice.select("h1", "h2", F.col("n").alias("size"), "rank", F.col("n")))
    rows = twice.agg(F.sum("n")).first()[0] or 0
    kept = join_by_count(lines, twice, ["h1", "h2"])
    kept = kept.repartitionByRange("doc_id", "key").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "key", "o")
    kept = kept.withColumn("at", F.monotonically_increasing_id()).select("key", "line", (F.col("o") - F.col("at")).alias("run"), "at", "w", "rank", F.col("size").alias("n"))  # run: equal where neighbours follow each other
    return materialise(kept), rows


def levels(active: DataFrame, top: int) -> list[DataFrame]:
    """Level k from 0 to top: key, run, at, rank and n of the suffixes whose first 2^k lines occur n > 1 times."""
    level = active.select("key", "run", "at", "rank", "n")
    out = [level]
    for k in range(top):
        ahead = Window.partitionBy("key", "run").orderBy("at").rangeBetween(1 << k, 1 << k)
        pairs = level.select("key", "run", "at", F.col("rank").alias("r1"), F.max("rank").over(ahead).alias("r2")).where("r2 IS NOT NULL")
        twice = _starts(pairs.groupBy("r1", "r2").agg(F.count("*").alias("n")).where("n > 1"), ["r1", "r2"])
        twice = materialise(twice.select("r1", "r2", F.col("n").alias("size"), "rank", "n"))
        level = materialise(join_by_count(pairs, twice, ["r1", "r2"]).select("key", "run", "at", "rank", F.col("size").alias("n")))
        release(twice)
        out.append(level)
    return out


def suffix_array(documents: DataFrame, doublings: int) -> DataFrame:
    """key, line, at, rank, n: suffixes that share their first 2^doublings lines with others, by the interval they form."""
    active, _ = _active(materialise(_lines(documents)))
    return levels(active, doublings)[-1].join(active.select("at", "line"), "at").select("key", "line", "at", "rank", "n")


def _windows(active: DataFrame, rows: int, min_words: int) -> DataFrame:
    """(at, size): the shortest stretch of min_words words from each line on and up to each line, within runs."""

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        key, run, at, w = (pdf[c].to_numpy() for c in ("key", "run", "at", "w"))
        order = np.lexsort((at, run, key))
        key, run, at, w = key[order], run[order], at[order], w[order]
        n = len(at)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (run[1:] != run[:-1])))
        lens = np.diff(starts, append=n)
        begin, end = np.repeat(starts, lens), np.repeat(starts + lens, lens)
        total = np.concatenate([[0], np.cumsum(w)])  # rises with every line
        here = np.arange(n)
        ends = np.searchsorted(total, total[:-1] + min_words, "left")  # smallest end with enough words
        begins = np.searchsorted(total, total[1:] - min_words, "right") - 1  # largest begin with enough words
        on, upto = ends <= end, begins >= begin
        found = np.concatenate([np.stack([at[on], (ends - here)[on]], axis=1), np.stack([at[begins[upto]], (here + 1 - begins)[upto]], axis=1)])
        found = np.unique(found, axis=0)
        return pd.DataFrame({"at": found[:, 0], "size": found[:, 1]})

    n = max(8, -(-rows // 50_000))
    mixed = active.withColumn("pack", F.pmod(F.hash("key"), F.lit(int(n))))
    return mixed.select("pack", "key", "run", "at", "w").groupBy("pack").applyInPandas(packed, "at long, size long")


def deleted_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, line) of the lines to delete; key as in `_row_key`."""
    lines = materialise(_lines(documents))
    active, rows = _active(lines)
    windows = materialise(_windows(active, rows, min_words).withColumn("k", F.floor(F.log2("size")).cast("int")))
    top = windows.agg(F.max("k")).first()[0] or 0
    ranked = None
    for k, level in enumerate(levels(active, top)):
        level = level.select(F.lit(k).alias("k"), "at", "rank")
        ranked = level if ranked is None else ranked.unionByName(level)
    first = ranked.select("k", "at", F.col("rank").alias("r1"))
    last = ranked.select("k", F.col("at").alias("tail"), F.col("rank").alias("r2"))
    keyed = windows.withColumn("tail", F.expr("at + size - shiftleft(1L, k)")).join(first, ["k", "at"]).join(last, ["k", "tail"])
    keyed = materialise(keyed.select("at", "size", "r1", "r2"))
    shared = materialise(keyed.groupBy("size", "r1", "r2").agg(F.min("at").alias("low"), F.count("*").alias("n")).where("n > 1"))
    later = join_by_count(keyed, shared, ["size", "r1", "r2"]).where("at > low").select(F.explode(F.expr("sequence(at, at + size - 1)")).alias("at")).distinct()
    return active.join(later, "at", "left_semi").select("key", "line")


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """The documents with text less the later copies, and the numbers of lines and of deleted ones.

    A column of the input that has one of these two names is replaced; give other names to keep it.
    """
    gone = materialise(deleted_lines(documents.select("doc_id", "text"), min_words).groupBy("key").agg(F.array_sort(F.collect_list("line")).alias("gone")))
    size = gone.agg(F.sum(F.size("gone"))).first()[0] or 0
    names = [c for c in documents.columns if c not in (n_lines, n_removed)]
    docs = documents.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), _row_key().alias("key"), "text")  # no name can clash
    joined = docs.join(F.broadcast(gone) if size <= BROADCAST_LINES else gone, "key", "left")
    # lines between one deleted line and the next stay as slices, so the work is lines plus deletions
    cut = joined.withColumn("lines", F.split("text", "\n")).withColumn("bounds", F.concat(F.array(F.lit(-1)), "gone", F.array(F.size("lines"))))
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.size("bounds") - 1), lambda j: F.slice("lines", F.element_at("bounds", j) + 2, F.element_at("bounds", j + 1) - F.element_at("bounds", j) - 1)))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n"))
    count = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.filter("lines", lambda x: x.rlike(r"\S")))).cast("long")
    removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    return cut.select(*(kept.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names), count.alias(n_lines), removed.alias(n_removed))
