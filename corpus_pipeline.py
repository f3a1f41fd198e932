"""A training corpus from `documents`: language, repeated lines, near duplicates, contamination, pieces.

Each stage takes the documents that the one before it kept, from the Parquet it was written to.

1. language_id: documents whose language is rejected (no letter, or no centroid as near as training rows of that length have one) go.
2. line_dedup: later copies of repeated line runs go; documents that lose all their lines go with them.
3. near_duplicates: one document of each group of similar ones stays, that of the smallest doc_id, the others go.
4. decontaminate: documents that hold benchmark passages beyond the limit go.
5. encode: digests of the ids, and of the text decoded from these ids, of every document that stays.

Nulls: a null text is rejected by stage 1; a null doc_id or null in another column stays as it is. Extra
columns go along through stages 1 to 4, whatever their names; stage 5 gives doc_id and digests alone. An empty table stays empty. A document is a doc_id with its text: rows with the same doc_id and text are one
document and stay or go together, rows with the same doc_id and another text are another document. A document without
doc_id is in no group of stage 3.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.llm import decontaminate, jaccard, langid, linededup, pieces
from regiscope.llm.common import in_small_batches, join_by_count, materialise, shared_dir
from regiscope.llm.queries import fold, model_path, table


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def _keyed(docs: DataFrame) -> DataFrame:
    """key (a hash of doc_id and text), doc_id, text, and the whole row."""
    return docs.select(_key(), "doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def _without(keyed: DataFrame, docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs whose key isn't among the given ones."""
    kept = keyed.join(F.broadcast(keys) if keys.count() <= jaccard.BLOCKS_BROADCAST else keys, "key", "left_anti")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    read = in_small_batches(docs.select(_key(), "doc_id", "text", "lang"))
    model = langid.train(read.where(fold(3) != 1).select("doc_id", "text", "lang"))
    return _without(_keyed(docs), docs, _rejected(read, model, docs.sparkSession))


def _rejected(keyed: DataFrame, model: langid.Model, spark: SparkSession) -> DataFrame:
    named = langid.identify(keyed.select(F.col("key").alias("doc_id"), "text"), model)
    return materialise(named.where("rejected").select(F.col("doc_id").alias("key")).distinct(), spark)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = _free(docs, "removed")
    kept = linededup.dedup_lines(docs, n_lines=_free(docs, "lines"), n_removed=removed)
    kept = kept.where(F.expr(f"`{removed}` = 0 OR text RLIKE '\\\\S'"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kept.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*(f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group one row's (doc_id, text) stays: the smallest doc_id, of its texts the one with the smallest hash. Equal rows stay together."""
    keyed = _keyed(docs)
    named = in_small_batches(keyed.where("doc_id IS NOT NULL").select("key", "doc_id", "text"))
    groups = jaccard.near_duplicates(named.select(F.col("key").alias("doc_id"), "text")).where("n_shingles > 0")
    groups = materialise(groups.select(F.col("doc_id").alias("key"), "component_id").distinct().join(named.select("key", "doc_id").distinct(), "key"))
    first = groups.groupBy("component_id").agg(F.min_by("key", F.struct("doc_id", "key")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = join_by_count(groups, materialise(first), ["component_id"]).where("key <> first").select("key")
    return _without(keyed, docs, materialise(later, docs.sparkSession))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    read = in_small_batches(keyed.select("key", "text"))
    found = decontaminate.contamination(read, table(read.sparkSession, sf_dir, "benchmark"), doc_id="key")
    return _without(keyed, docs, materialise(found.where("contaminated").select(F.col("doc_id").alias("key")).distinct(), docs.sparkSession))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    read = in_small_batches(docs.select("doc_id", "text"))
    return materialise(pieces.encode_decode(read, model_path()), docs.sparkSession)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontaminate", decontaminated), ("encode", encode)]

#: Stages 1 and 5 cannot be written in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs
