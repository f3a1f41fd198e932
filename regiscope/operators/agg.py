"""Grouped summaries, windows, ordering, sampling and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiscope.functions.exprs import percent_change
from regiscope.sources.io import written


def frequency(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Counts of value combinations, rows with a NULL left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias(name))


def proportions(df: DataFrame, *columns: str, within: list[str] | None = None) -> DataFrame:
    """Counts and their per cent of the whole table, or of the groups of `within`."""
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*(within or [])))
    return frequency(df, *columns).withColumn("pct", share)


def count_histogram(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows_per_key")).groupBy("rows_per_key").agg(F.count("*").alias("keys"))


def growth(df: DataFrame, keys: list[str], last: str, this: str, least: int = 1) -> DataFrame:
    """Sums of both years, their change in per cent and group size, for groups of at least `least` rows."""
    sums = df.groupBy(*keys).agg(F.sum(last).alias("total_last"), F.sum(this).alias("total_this"), F.count("*").alias("n"))
    return sums.where(F.col("n") >= least).withColumn("pct_change", percent_change(F.col("total_last"), F.col("total_this")))


def distinct_with_null(c: str) -> Column:
    """Number of distinct values; NULL counts as one."""
    return F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))


def strict(aggregate: Column, c: str) -> Column:
    """An aggregate that is NULL if any value is."""
    return F.when(F.count_if(F.col(c).isNull()) == 0, aggregate)


def share_true(predicate: Column) -> Column:
    """Per cent of rows where the predicate holds, of those where it is not NULL."""
    return F.avg(predicate.cast("int")) * 100


def first_rows(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One full row per key: the first in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def arg_max(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """The row of the greatest value per key, the smallest `tie` of equal ones."""
    return first_rows(df, keys, [F.desc(value), F.asc(tie)])


def with_group(df: DataFrame, keys: list[str], few: bool = False, **values: Column) -> DataFrame:
    """Adds aggregates of each row's group (NULL keys are a group of their own).

    Groups are summed before the shuffle and joined back, so a group of any size is never gathered in one task as by a window.
    With `few` the caller says that a group's rows are few by nature (the lines of an order): then it is a window, one scan and one shuffle.
    """
    if few:
        w = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(w) for n, c in values.items()})
    sums = df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(*(c.alias(n) for n, c in values.items()))
    if not keys:
        return df.crossJoin(F.broadcast(sums))  # one row
    on = [df[k].eqNullSafe(sums[f"_{k}"]) for k in keys]
    return df.join(sums, on, "inner").drop(*(f"_{k}" for k in keys))


def at_group_max(df: DataFrame, keys: list[str], value: str, ties: str = "all", order: list | None = None) -> DataFrame:
    """Rows at their group's maximum; a group with a NULL value has none. ties="first" keeps one row, by `order`."""
    out = with_group(df, keys, _max=F.max(value), _null=F.count_if(F.col(value).isNull()))
    out = out.where((F.col("_null") == 0) & (F.col(value) == F.col("_max"))).drop("_max", "_null")
    return out if ties == "all" else first_rows(out, keys, order or [value])


def latest(df: DataFrame, key: str, date: str) -> DataFrame:
    """Single rows as they are; of several rows per key those of the latest date, none if any date is NULL.

    A key's rows are few (the accounts of a company), so this is one window.
    """
    w = Window.partitionBy(key)
    out = df.withColumn("_n", F.count("*").over(w)).withColumn("_max", F.max(date).over(w)).withColumn("_null", F.count_if(F.col(date).isNull()).over(w))
    return out.where((F.col("_n") == 1) | ((F.col("_null") == 0) & (F.col(date) == F.col("_max")))).drop("_n", "_max", "_null")


def share_of_group(df: DataFrame, keys: list[str], value: str, few: bool = False) -> DataFrame:
    out = with_group(df, keys, few, _total=F.sum(value), group_count=F.count("*"))
    return out.withColumn("pct", F.col(value) / F.col("_total") * 100).drop("_total")


def having_total(df: DataFrame, keys: list[str], value: str, least: float) -> DataFrame:
    """Rows of groups whose values sum up to at least so much."""
    return with_group(df, keys, _t=F.sum(value)).where(F.col("_t") >= least).drop("_t")


def repeated(df: DataFrame, keys: list[str], times: int = 2) -> DataFrame:
    """All rows of keys that exactly so many rows have."""
    return with_group(df, keys, _n=F.count("*")).where(F.col("_n") == times).drop("_n")


def median(value: str, approximate: bool = False) -> Column:
    """Median; the exact one holds a group's distinct values in memory, the approximate one (within 1 / 10,000 of the rank) does not."""
    return F.percentile_approx(value, 0.5, 10_000) if approximate else F.median(value)


#: Equal parts that a round of `quantiles` cuts a range into, and rows in a range that are ranked directly.
PARTS, FEW = 1024, 1000


def _binade(c: Column) -> Column:
    """The power of two a number lies at, with its sign: rises with the number, from -2,200 to 2,200."""
    size = F.floor(F.least(F.log2(F.abs(c)), F.lit(1025.0))) + 1100
    return F.when(c > 0, size).when(c < 0, -size).otherwise(F.lit(0)).cast("long")


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float], parts: int = PARTS, few: int = FEW) -> DataFrame:
    """(keys, n, quantiles): exact quantiles as F.percentile gives them, of groups of any size; NULL and NaN values are left out.

    Selection by refinement: for each rank that is asked for, a round counts the group's values by parts of the range the rank
    lies in (added up before the shuffle) and keeps the part that holds it, with the part's own least and greatest value as the
    next range. Parts are powers of two where the range spans more than two of them, else `parts` equal ones. A range of one
    value, or of `few` rows, is settled; the rows of the latter are ranked. Evenly spread values take about log n / log `parts`
    rounds (three or four for 10^12), any values at most 8 with 1,024 parts, as a double has 52 bits beside its power.
    No task holds a group's values. Groups without values are left out.
    """
    v = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    same = lambda a, b: [a[k].eqNullSafe(b[f"_key_{k}"]) for k in keys]
    named = [F.col(k).alias(f"_key_{k}") for k in keys]
    groups = written(v.groupBy(*named).agg(F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high")).where("n > 0"))
    own = [f"_key_{k}" for k in keys]
    at = [(F.col("n") - 1) * p for p in probabilities]
    ranks = F.array_distinct(F.concat(*(F.array(F.floor(a).cast("long"), F.ceil(a).cast("long")) for a in at)))
    open_ = groups.select(*own, F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), "low", "high")
    settled = None
    while True:
        done = open_.where("low = high").select(*own, "rank", F.col("low").alias("x"))
        settled = written(done if settled is None else settled.unionByName(done))
        open_ = written(open_.where("low < high"))
        if not open_.where(F.col("inside") > few).limit(1).count():
            break
        wide = open_.where(F.col("inside") > few)
        q = F.coalesce(F.try_divide(F.col("__v") - F.col("low"), F.col("high") / parts - F.col("low") / parts), F.lit(0.0))
        even = F.when(F.col("__v") >= F.col("high"), parts - 1).otherwise(F.floor(F.least(q, F.lit(parts - 2.0))))  # so the greatest value is never with the least
        part = F.when(_binade(F.col("high")) - _binade(F.col("low")) > 1, _binade(F.col("__v"))).otherwise(even)
        near = v.join(wide, same(v, wide) + [v["__v"].between(wide["low"], wide["high"])]) if keys else v.crossJoin(F.broadcast(wide)).where("__v BETWEEN low AND high")  # a few ranks
        counts = near.groupBy(*own, "rank", "below", part.alias("part")).agg(F.count("*").alias("c"), F.min("__v").alias("low"), F.max("__v").alias("high"))
        upto = F.sum("c").over(Window.partitionBy(*own, "rank").orderBy("part"))  # `parts` rows a rank
        counts = counts.withColumn("upto", F.col("below") + upto).where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("c") <= F.col("rank")))
        narrower = counts.select(*own, "rank", (F.col("upto") - F.col("c")).alias("below"), F.col("c").alias("inside"), "low", "high")
        open_ = open_.where(F.col("inside") <= few).unionByName(narrower)
    near = v.join(open_, same(v, open_) + [v["__v"].between(open_["low"], open_["high"])]) if keys else v.crossJoin(F.broadcast(open_)).where("__v BETWEEN low AND high")
    order = Window.partitionBy(*own, "rank").orderBy("__v")  # `few` rows a rank
    ranked = near.withColumn("_place", F.col("below") + F.row_number().over(order) - 1).where(F.col("_place") == F.col("rank")).select(*own, "rank", F.col("__v").alias("x"))
    values = settled.unionByName(ranked).groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))  # two ranks a probability
    out = groups.select(*(F.col(f"_key_{k}").alias(k) for k in keys), "n", *own).join(values.withColumnsRenamed({k: f"_key_{k}" for k in own}), [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in own]) if keys else groups.crossJoin(F.broadcast(values))
    found = []
    for a in at:
        low, high = F.floor(a).cast("long"), F.ceil(a).cast("long")
        a0, a1 = F.element_at("at", low), F.element_at("at", high)
        found.append(F.when((low == high) | (a0 == a1), a0).otherwise((high - a) * a0 + (a - low) * a1))
    return out.select(*keys, "n", F.array(*found).alias("quantiles"))


def category_rank(df: DataFrame, category: str, statistic: Column) -> DataFrame:
    """Categories ranked by a group statistic. The window runs over one row per category."""
    return df.groupBy(category).agg(statistic.alias("stat")).withColumn("rank", F.row_number().over(Window.orderBy("stat", category)))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def to_long(df: DataFrame, ids: list[str], values: list[str], names_to: str, values_to: str) -> DataFrame:
    return df.unpivot(ids, values, names_to, values_to)
