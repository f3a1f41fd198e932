"""An inverted index over facts: postings by trigram of a fact's name and value, added to archive by archive.

Postings lie in a folder for each range of trigrams (by a hash) and archive, a row for each trigram and stretch of facts; facts
lie in a folder for each archive and stretch. A search takes the runs of plain characters that every match of its pattern must hold, reads the postings of their
trigrams alone, the rarest first, intersects them, and checks the facts that are left with the pattern itself. So what it finds is
what a scan of all facts finds. Patterns without such a run of three characters (or with alternatives) are a scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.sources.io import delete, write_partitioned, written

#: Ranges of trigrams; facts of a stretch; trigrams of a search whose postings are read.
RANGES, STRETCH, GRAMS = 64, 1 << 16, 6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text() -> Column:
    """What a search sees of a fact, in lower case (A-Z)."""
    return F.translate(F.concat_ws(" ", "name", "value"), UPPER, LOWER)


def _range(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(RANGES)).cast("int")


def add(facts: DataFrame, path: str, archive: str = "archive") -> None:
    """Adds facts (name, value, archive and other columns) to the index at path. Archives that it has already are replaced as wholes; an addition that broke off is repeated."""
    spark = facts.sparkSession
    numbered = written(facts.withColumn("_folder", F.sha2(F.col(archive).cast("string"), 256)).withColumn("_id", F.monotonically_increasing_id()))
    folders = [r[0] for r in numbered.select("_folder").distinct().collect()]  # a row an archive
    for folder in folders:
        for part in ("facts", "grams", "postings"):
            delete(spark, f"{path}/{part}/_folder={folder}")
    numbered = numbered.withColumn("_stretch", F.shiftright("_id", STRETCH.bit_length() - 1))
    write_partitioned(numbered, f"{path}/facts", ["_folder", "_stretch"])
    # a text that many facts of a stretch have is cut into trigrams once, and a trigram's facts there are one row
    texts = numbered.withColumn("_t", _text()).where(F.length("_t") >= 3).groupBy("_folder", "_stretch", "_t").agg(F.collect_list("_id").alias("_ids"))
    grams = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_t") - 2), lambda i: F.substring(F.col("_t"), i, F.lit(3))))).alias("gram")
    held = texts.select("_folder", "_stretch", "_ids", grams).groupBy("_folder", "_stretch", "gram").agg(F.flatten(F.collect_list("_ids")).alias("_ids"))
    postings = held.withColumn("_range", _range(F.col("gram")))
    write_partitioned(postings.repartition("_folder", "_range").sortWithinPartitions("_folder", "_range", "gram"), f"{path}/postings", ["_folder", "_range"])
    stored = spark.read.parquet(f"{path}/postings").where(F.col("_folder").isin(folders))
    write_partitioned(stored.groupBy("_folder", "_range", "gram").agg(F.sum(F.size("_ids")).alias("n")), f"{path}/grams", ["_folder", "_range"])


def literals(pattern: str) -> list[str] | None:
    """Runs of plain characters that every match of a pattern holds, in lower case; None if none of three is sure."""
    if "|" in pattern or "(?" in pattern:
        return None
    flat = re.sub(r"\\[bBAzZ]", "\0", pattern)
    flat = re.sub(r"\\([^A-Za-z0-9])", lambda m: m[1] if m[1] not in "\\.*+?{}()[]^$" else "\0", flat)
    flat = re.sub(r"\\.|\[(?:\\.|[^\]])*\]", "\0", flat)
    while (inner := re.sub(r"\([^()]*\)", "\0", flat)) != flat:  # what groups hold may be left out by what follows them
        flat = inner
    flat = re.sub(r"[^\0][*?]|[^\0]\{[^}]*\}", "\0", flat)  # a character that may be missing
    runs = [r for r in re.split(r"[\0.*+?{}()\[\]^$\\]+", flat) if len(r) >= 3 and r.isascii()]
    return [r.translate(str.maketrans(UPPER, LOWER)) for r in runs] or None


def search(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The facts whose name and value hold the pattern, whatever the case."""
    facts = spark.read.parquet(f"{path}/facts")
    runs = literals(pattern)
    if runs is not None:
        grams = sorted({r[i : i + 3] for r in runs for i in range(len(r) - 2)})
        wanted = spark.createDataFrame([(g,) for g in grams], "gram string").select("gram", _range(F.col("gram")).alias("_range")).collect()
        ranges = sorted({r["_range"] for r in wanted})
        of = lambda part: spark.read.parquet(f"{path}/{part}").where(F.col("_range").isin(ranges) & F.col("gram").isin(grams))
        counts = {r.gram: r.n for r in of("grams").groupBy("gram").agg(F.sum("n").alias("n")).collect()}  # a row a trigram of the pattern
        rare = sorted(grams, key=lambda g: (counts.get(g, 0), g))[:GRAMS]
        rare_ranges = sorted({r["_range"] for r in wanted if r["gram"] in rare})
        hits = spark.read.parquet(f"{path}/postings").where(F.col("_range").isin(rare_ranges) & F.col("gram").isin(rare))
        hits = hits.select("_folder", "_stretch", F.explode("_ids").alias("_id")).groupBy("_folder", "_stretch", "_id").agg(F.count("*").alias("_n")).where(F.col("_n") == len(rare)).drop("_n")
        facts = facts.join(hits, ["_folder", "_stretch", "_id"], "left_semi")
    return facts.where(F.concat_ws(" ", "name", "value").rlike("(?i)" + pattern)).drop("_folder", "_id", "_stretch")
