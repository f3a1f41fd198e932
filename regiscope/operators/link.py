"""Joins. Whether a side is broadcast is left to the optimizer, which knows its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _on(a: DataFrame, b: DataFrame, left: str, right: str, null_keys_match: bool) -> Column:
    return a[left].eqNullSafe(b[right]) if null_keys_match else a[left] == b[right]


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str | None = None, how: str = "left", null_keys_match: bool = False) -> DataFrame:
    """Equi-join with a lookup; the key is kept once, by its name on the left. Repeated lookup keys repeat rows."""
    other = table.withColumnRenamed(table_key or key, "_key")
    joined = df.join(other, _on(df, other, key, "_key", null_keys_match), how)
    if how in ("right", "full_outer"):
        joined = joined.withColumn(key, F.coalesce(key, "_key"))
    return joined.drop("_key")


def located(df: DataFrame, postcodes: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Rows that the lookup gives coordinates for."""
    return lookup(df, postcodes, key).where(F.col(x).isNotNull() & F.col(y).isNotNull())


def members(df: DataFrame, others: DataFrame, key: str, other_key: str | None = None, inside: bool = True) -> DataFrame:
    """Rows whose key occurs (or not) among the other keys; NULL is found only among NULLs."""
    keys = others.select(F.col(other_key or key).alias("_key")).distinct()
    return df.join(keys, df[key].eqNullSafe(keys["_key"]), "left_semi" if inside else "left_anti")


def match_report(df: DataFrame, others: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows with and without a match, and their per cent."""
    keys = others.select(F.col(other_key or key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    flags = df.join(keys, df[key].eqNullSafe(keys["_key"]), "left").select(F.coalesce("_hit", F.lit(False)).alias("matched"))
    counts = flags.groupBy("matched").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("matched", "n", (F.col("n") * 100.0 / F.col("total")).alias("pct"))  # one row


def overlap_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys found by one method, the other, or both."""
    x = a.select(key).distinct().withColumn("in_a", F.lit(True))
    y = b.select(F.col(key).alias("_key")).distinct().withColumn("in_b", F.lit(True))
    both = x.join(y, x[key] == y["_key"], "full_outer")
    return both.groupBy(F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b")).agg(F.count("*").alias("n"))
