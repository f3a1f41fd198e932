"""Distances under permutation, regressions, densities, histograms and class breaks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiscope.functions.exprs import log10
from regiscope.operators import agg
from regiscope.sources.io import written


def ols_by_group(df: DataFrame, keys: list[str], y: str, x: str) -> DataFrame:
    """Slope and standard error of y on x per group; NULL with under 2 points or one x, NaN error with 2."""
    g = df.groupBy(*keys).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("_b"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"))
    fit = (F.col("n") >= 2) & (F.col("_sxx") > 0)
    left = F.greatest(F.lit(0.0), F.col("_syy") - F.col("_sxy") * F.try_divide("_sxy", "_sxx"))
    se = F.when(F.col("n") == 2, F.lit(float("nan"))).otherwise(F.sqrt(F.try_divide(F.try_divide(left, F.col("n") - 2), F.col("_sxx"))))
    return g.withColumn("slope", F.when(fit, F.col("_b"))).withColumn("se", F.when(fit, se)).select(*keys, "n", "slope", "se")


#: Points of a pack at most; rows and columns of blocks that a key's pairs of packs are dealt to; pairs made at once, few enough for a core's cache.
PACK, SIDE, AT_ONCE = 4096, 6, 1 << 15


def pair_packs(a: DataFrame, b: DataFrame, key: str = "rep") -> DataFrame:
    """(key, ax, ay, bx, by): packs of doubles (bytes), so that every pair of points (x, y) of two tables that have a key is in one row's product.

    Pairs are never rows. A pack of the first table goes to a row of blocks and one of the second to a column, so the tables are
    sent SIDE times each; tasks get blocks of a key, and never more of it than two packs at a time. Points without coordinates make no pair.
    The tables are scanned once for each pass, so they should be stored.
    """
    tasks = 4 * a.sparkSession.sparkContext.defaultParallelism

    def pack(batches):
        held: dict = {}
        for pdf in batches:
            out = []
            for k, part in pdf.groupby(key, sort=False):
                xs, ys = (np.concatenate([old, part[c].to_numpy()]) for old, c in zip(held.get(k, (np.empty(0),) * 2), ("x", "y")))
                whole = len(xs) - len(xs) % PACK
                out += [(k, xs[at : at + PACK].tobytes(), ys[at : at + PACK].tobytes()) for at in range(0, whole, PACK)]
                held[k] = xs[whole:], ys[whole:]
            yield pd.DataFrame(out, columns=[key, "x", "y"])
        yield pd.DataFrame([(k, xs.tobytes(), ys.tobytes()) for k, (xs, ys) in held.items() if len(xs)], columns=[key, "x", "y"])

    sides = []
    for df, own, other, names in ((a, "_i", "_j", ("ax", "ay")), (b, "_j", "_i", ("bx", "by"))):
        packs = df.where("x IS NOT NULL AND y IS NOT NULL").select(F.col(key).cast("long").alias(key), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).mapInPandas(pack, f"`{key}` long, x binary, y binary")
        dealt = packs.select(key, F.col("x").alias(names[0]), F.col("y").alias(names[1]), F.pmod(F.xxhash64("x", "y"), F.lit(SIDE)).cast("int").alias(own))
        sides.append(dealt.withColumn(other, F.explode(F.lit(list(range(SIDE))))).repartition(tasks, key, "_i", "_j"))
    return sides[0].hint("merge").join(sides[1], [key, "_i", "_j"]).drop("_i", "_j")  # a merge: no side is gathered in the driver


def _distances(ax: bytes, ay: bytes, bx: bytes, by: bytes):
    """All distances between the points of two packs, some at a time."""
    ax, ay, bx, by = (np.frombuffer(v) for v in (ax, ay, bx, by))
    step = max(1, AT_ONCE // len(bx))
    for k in range(0, len(ax), step):
        d, dy = ax[k : k + step, None] - bx, ay[k : k + step, None] - by
        d *= d
        dy *= dy
        d += dy
        yield np.sqrt(d, out=d).ravel()


def pair_summary(packs: DataFrame, key: str = "rep") -> DataFrame:
    """(key, n, lo, hi, sd, mean_distance) of the distances of all pairs of points of `pair_packs`."""

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                for d in _distances(row.ax, row.ay, row.bx, row.by):
                    total = d.sum()
                    out.append((getattr(row, key), len(d), total, ((d - total / len(d)) ** 2).sum() + total * total / len(d), d.min(), d.max()))
            each = pd.DataFrame(out, columns=[key, "n", "s", "ss", "lo", "hi"])
            yield each.groupby(key, as_index=False).agg({"n": "sum", "s": "sum", "ss": "sum", "lo": lambda v: v.min(skipna=False), "hi": lambda v: v.max(skipna=False)})

    each = packs.select(key, "ax", "ay", "bx", "by").mapInPandas(run, f"`{key}` long, n long, s double, ss double, lo double, hi double")
    s = each.groupBy(key).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    sd = F.when(F.col("n") < 2, None).when(F.col("lo") == F.col("hi"), 0.0).otherwise(F.sqrt(F.greatest(F.lit(0.0), F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)))
    return s.select(key, "n", "lo", "hi", sd.alias("sd"), (F.col("s") / F.col("n")).alias("mean_distance"))


def mean_distance(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mean distance over all pairs of points (x, y) of two tables. Pairs are never rows."""
    sides = [written(df.select(F.lit(0).cast("long").alias("rep"), "x", "y")) for df in (a, b)]
    return pair_summary(pair_packs(*sides)).agg(F.max("mean_distance").alias("mean_distance"))


def drawn_sides(points: DataFrame, n1: Column | int, n2: Column | int, reps: int, key: str = "id", seed: str = "") -> list[DataFrame]:
    """Two tables (rep, x, y): samples without replacement, of n1 and n2 points, in each repetition."""
    spread = points.crossJoin(F.broadcast(points.sparkSession.range(reps).withColumnRenamed("id", "rep")))  # `reps` rows
    sides = []
    for side, n in (("x", n1), ("y", n2)):
        h = spread.withColumn("_h", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("rep").cast("string"), F.lit(side + seed)))).withColumn("_b", F.substring("_h", 1, 3))
        # the n least by hash: all of the buckets before the one that holds the n-th, and the least of that one
        upto = Window.partitionBy("rep").orderBy("_b")
        last = h.groupBy("rep", "_b").agg(F.count("*").alias("_n")).withColumn("_to", F.sum("_n").over(upto))  # 4,096 rows a repetition at most
        last = last.withColumn("_room", n - (F.col("_to") - F.col("_n"))).where("_room > 0").groupBy("rep").agg(F.max_by("_b", "_b").alias("_last"), F.max_by("_room", "_b").alias("_room"))
        near = h.join(F.broadcast(last), "rep").where("_b <= _last")  # `reps` rows
        whole = near.where("_b < _last").select("rep", "x", "y")
        rank = F.row_number().over(Window.partitionBy("rep").orderBy("_h", key))
        sides.append(whole.unionByName(near.where("_b = _last").withColumn("_k", rank).where("_k <= _room").select("rep", "x", "y")))
    return sides


def colocation(points: DataFrame, group: str, first: str, second: str, reps: int = 1000, peaks: bool = True) -> DataFrame:
    """One row: observed mean distance of two groups, mean and deviation of the mean under permutation, z score.

    With `peaks` the same of the density peak of the distances: observed_peak, expected_peak, sd_peak, z_peak.
    """
    a, b = points.where(F.col(group) == first), points.where(F.col(group) == second)
    n1, n2 = a.count(), b.count()
    drawn = drawn_sides(points.select("id", "x", "y"), n1, n2, reps)
    sides = [written(seen.select(F.lit(-1).cast("long").alias("rep"), "x", "y").unionByName(side)) for seen, side in zip((a, b), drawn)]  # drawn once; the observed pairs as one more repetition
    packs = pair_packs(*sides)
    return _scores(distance_peaks(packs, "rep") if peaks else pair_summary(packs), peaks)


def _scores(each: DataFrame, peaks: bool) -> DataFrame:
    """Observed value (rep -1), mean, deviation and z score over the other repetitions."""
    found = []
    for c, end in (("mean_distance", ""), ("peak", "_peak"))[: 1 + peaks]:
        drawn = F.when(F.col("rep") >= 0, F.col(c))
        found += [F.max(F.when(F.col("rep") < 0, F.col(c))).alias(f"observed{end}"), F.avg(drawn).alias(f"expected{end}"), F.stddev_samp(drawn).alias(f"sd{end}")]
    out = each.agg(*found)
    for end in ("", "_peak")[: 1 + peaks]:
        out = out.withColumn(f"z{end}", F.try_divide(F.col(f"observed{end}") - F.col(f"expected{end}"), F.col(f"sd{end}")))
    return out


def distance_peaks(packs: DataFrame, key: str = "rep", points: int = 512, bins: int = 4096) -> DataFrame:
    """(key, mean_distance, peak): mean and density peak, as `density` has it, of the distances of `pair_packs` by key.

    Two passes over the pairs; the density and its bandwidth's quartiles come from the bins, so no task holds a key's distances.
    """
    s = written(pair_summary(packs, key))
    at = packs.join(F.broadcast(s.select(key, "lo", F.greatest((F.col("hi") - F.col("lo")) / bins, F.lit(1e-300)).alias("step"))), key)  # a row a key, so that packs stay where they are

    def run(batches):
        last, w, m = None, None, None

        def found() -> pd.DataFrame:
            b = np.flatnonzero(w)
            return pd.DataFrame({key: np.full(len(b), last), "b": b, "w": w[b], "m": m[b]})

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if getattr(row, key) != last:
                    if last is not None:
                        yield found()
                    last, w, m = getattr(row, key), np.zeros(bins + 2, np.int64), np.zeros(bins + 2)
                for d in _distances(row.ax, row.ay, row.bx, row.by) if np.isfinite(row.step) else ():
                    b = ((d - row.lo) / row.step).astype(np.int64)
                    w += np.bincount(b, minlength=bins + 2)
                    m += np.bincount(b, d, bins + 2)
        if last is not None:
            yield found()

    each = at.select(key, "ax", "ay", "bx", "by", "lo", "step").mapInPandas(run, f"`{key}` long, b long, w long, m double")
    binned = s.join(each.groupBy(key, "b").agg(F.sum("w").alias("w"), (F.sum("m") / F.sum("w")).alias("m")), key, "left")  # without bins: distances that are not finite

    def peak(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("b")
        one = pdf.iloc[0]
        return pd.DataFrame({key: [int(one[key])], "mean_distance": [one.mean_distance], "peak": [_peak(pdf.m.to_numpy(), pdf.w.to_numpy(), one.n, one.lo, one.hi, one.sd, points) if pdf.w.notna().all() else math.nan]})

    return binned.groupBy(key).applyInPandas(peak, f"{key} long, mean_distance double, peak double")


def _peak(m: np.ndarray, w: np.ndarray, n: float, lo: float, hi: float, sd: float, points: int = 512) -> float:
    """Density peak of n values in bins of ascending means m and counts w."""
    q1, q3 = m[np.searchsorted(w.cumsum(), (0.25 * n, 0.75 * n))]
    spread = min(sd, (q3 - q1) / 1.34) if n > 1 else 0.0
    width = 0.9 * (spread or (sd if n > 1 and sd > 0 else 1.0)) * n**-0.2
    grid = np.linspace(lo - 3 * width, hi + 3 * width, points)
    return grid[(np.exp(-0.5 * ((grid[:, None] - m) / width) ** 2) @ w).argmax()]


#: Most points that numpy draws from without replacement; of more, draws are with replacement, which differs by less than any sample can show.
DRAWN = 10**9


def colocation_by_grid(points: DataFrame, group: str, first: str, second: str, reps: int = 1000, cells: int = 512, seed: int = 0) -> DataFrame:
    """`colocation` with peaks, by how many points each cell of a square grid over all points holds; and `within`, the cell's diagonal.

    One pass counts the points and both groups by cell: `cells` squared rows at most, whatever the table's size. A repetition
    draws both samples' counts by cell (of the cells' counts, without replacement: the same distribution as drawing points),
    and the numbers of pairs by offset between cells are the cross-correlation of the two, by Fourier transform: no point and no
    pair is made again. A pair's distance is taken as the mean over its two cells, so every distance, and with it a mean, is
    within the diagonal of that of the points. Points without finite coordinates are left out; a group without points gives nulls.
    """
    spark = points.sparkSession
    p = points.where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) < double('infinity')" for c in ("x", "y")))
    low_x, high_x, low_y, high_y = p.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    size = (max(high_x - low_x, high_y - low_y) / cells or 1.0) if low_x is not None else 1.0
    at = lambda c, low: F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(size)), F.lit(cells - 1)).cast("int")
    counts = p.groupBy(at("x", low_x).alias("i"), at("y", low_y).alias("j")).agg(F.count("*").alias("n"), F.count_if(F.col(group) == first).alias("a"), F.count_if(F.col(group) == second).alias("b")).toPandas()
    i, j, n, a, b = (counts[c].to_numpy() for c in ("i", "j", "n", "a", "b"))

    def run(batches):
        away = _cell_distances(cells)
        for pdf in batches:
            out = []
            for rep in pdf["rep"]:
                rng = np.random.default_rng([seed, rep + 1])
                draw = lambda k: rng.multivariate_hypergeometric(n, k, method="marginals") if n.sum() < DRAWN else rng.multinomial(k, n / n.sum())
                left, right = (a, b) if rep < 0 else (draw(a.sum()), draw(b.sum()))
                out.append((rep, *_mean_and_peak(_offsets(i, j, left, right, cells), away, size)))
            yield pd.DataFrame(out, columns=["rep", "mean_distance", "peak"])

    tasks = min(reps + 1, 4 * spark.sparkContext.defaultParallelism)
    each = spark.range(-1, reps, 1, tasks).withColumnRenamed("id", "rep")
    none = len(counts) == 0 or not a.sum() or not b.sum()
    each = each.select("rep", F.lit(None).cast("double").alias("mean_distance"), F.lit(None).cast("double").alias("peak")) if none else each.mapInPandas(run, "rep long, mean_distance double, peak double")
    return _scores(each, True).withColumn("within", F.lit(size * math.sqrt(2)))


def _cell_distances(cells: int, parts: int = 8) -> np.ndarray:
    """Mean distance, in cells, of points spread evenly over two cells, by the offset between them; cells are taken as `parts` by `parts` points."""
    k = np.arange(1 - parts, parts)
    weight, shift, at = (parts - np.abs(k)) / parts**2, k / parts, np.arange(cells)
    out = np.zeros((cells, cells))
    for wx, sx in zip(weight, shift):
        for wy, sy in zip(weight, shift):
            out += wx * wy * np.hypot((at + sx)[:, None], (at + sy)[None])
    return out


def _offsets(i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray, cells: int) -> np.ndarray:
    """Numbers of pairs by offset between their cells, without its sign."""
    grids = []
    for w in (left, right):
        g = np.zeros((cells, cells))
        g[i, j] = w
        grids.append(np.fft.rfft2(g, (2 * cells, 2 * cells)))
    pairs = np.rint(np.fft.irfft2(grids[0] * grids[1].conj(), (2 * cells, 2 * cells)))
    for axis in (0, 1):  # offsets d and -d together
        pairs = pairs.swapaxes(0, axis)
        folded = pairs[:cells].copy()
        folded[1:] += pairs[: cells : -1]
        pairs = folded.swapaxes(0, axis)
    return np.maximum(pairs, 0)


def _mean_and_peak(pairs: np.ndarray, away: np.ndarray, size: float, bins: int = 4096) -> tuple[float, float]:
    met = pairs > 0
    d, w = away[met] * size, pairs[met]
    n, mean = w.sum(), np.average(d, weights=w)
    lo, hi = d.min(), d.max()
    sd = math.sqrt((w * (d - mean) ** 2).sum() / (n - 1)) if n > 1 else math.nan
    b = np.minimum((d - lo) / max((hi - lo) / bins, 1e-300), bins - 1).astype(np.int64)
    by, sums = np.bincount(b, w, bins), np.bincount(b, w * d, bins)
    held = by > 0
    return float(mean), float(_peak(sums[held] / by[held], by[held], n, lo, hi, sd))


def density(df: DataFrame, group: str, value: str, points: int = 512, bins: int = 2048, large: bool = False) -> DataFrame:
    """(group, x, density): Gaussian kernel density on a grid over the range and three bandwidths beyond.

    Values are binned first, so the work beyond one pass is bins x points per group. With `large` the quartiles of its
    bandwidth come by refinement (`agg.quantiles`), which holds no group's values.
    """
    v = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    q = F.percentile("v", F.array(F.lit(0.25), F.lit(0.75)))
    s = v.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"), *([] if large else [q.alias("q")]))
    if large:
        q = agg.quantiles(v, ["g"], "v", [0.25, 0.75]).select(F.col("g").alias("_g"), F.col("quantiles").alias("q"))
        s = s.join(q, s["g"].eqNullSafe(q["_g"])).drop("_g")
    spread = F.least("sd", (F.col("q")[1] - F.col("q")[0]) / 1.34)
    spread = F.when(spread > 0, spread).when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    s = s.withColumn("bw", 0.9 * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    s = s.withColumn("step", F.greatest((F.col("hi") - F.col("lo")) / bins, F.lit(1e-300)))
    binned = v.join(s.select("g", "lo", "step"), "g").withColumn("b", F.floor((F.col("v") - F.col("lo")) / F.col("step")))
    binned = binned.groupBy("g", "b").agg(F.count("*").alias("w"), F.avg("v").alias("m"))
    grid = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", F.col("lo") - 3 * F.col("bw") + F.col("k") * (F.col("hi") - F.col("lo") + 6 * F.col("bw")) / (points - 1))
    z = (F.col("x") - F.col("m")) / F.col("bw")
    summed = grid.select("g", "x", "bw", "n").join(binned, "g").groupBy("g", "x", "bw", "n").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
    return summed.select(F.col("g").alias(group), "x", (F.col("s") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))).alias("density"))


def density_peak(df: DataFrame, group: str, value: str, large: bool = False) -> DataFrame:
    return density(df, group, value, large=large).groupBy(group).agg(F.max_by("x", F.struct("density", -F.col("x"))).alias("peak"))


def histogram(df: DataFrame, value: str, bins: int = 30, facet: list[str] | None = None) -> DataFrame:
    """Counts and densities in equal bins of the whole table's range (the last bin holds its upper edge), by facet."""
    box = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(box))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("lo"), width)), F.lit(0))).cast("int")
    counts = at.groupBy(*(facet or []), b.alias("bin"), width.alias("width")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*(facet or [])))
    return counts.withColumn("density", F.try_divide(F.col("n"), total * F.col("width"))).drop("width")


def month_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows per month from the first to the last month, months without rows too."""
    m = df.where(F.col(date).isNotNull()).groupBy(F.trunc(F.col(date).cast("date"), "month").alias("month")).agg(F.count("*").alias("n"))
    span = m.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a IS NOT NULL")
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return months.join(m, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


def box_plot(df: DataFrame, group: str, value: str, large: bool = False) -> DataFrame:
    """Quartiles, whiskers at most 1.5 quartile ranges away, and the group's rank by median. With `large` the quartiles come by refinement."""
    if large:
        q = agg.quantiles(df, [group], value, [0.25, 0.5, 0.75]).withColumnRenamed("quantiles", "q")
    else:
        q = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    q = q.select(group, *(F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.when(F.col(value).between(F.col("q1") - reach, F.col("q3") + reach), F.col(value))
    out = df.join(q, group).groupBy(group, "q1", "median", "q3").agg(F.min(inside).alias("low"), F.max(inside).alias("high"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy("median", group)))  # one row per group


def log_density(df: DataFrame, group: str, value: str, points: int = 512) -> DataFrame:
    """(group, x, density) of the values' common logarithms; values that aren't positive are left out."""
    return density(df.select(group, log10(F.col(value)).alias("_log")), group, "_log", points)


#: Up to so many levels the breaks are searched in two steps; of more, each step is FAN times as fine as the one before.
TWO_STEPS, FAN = 1 << 16, 16


def natural_breaks(df: DataFrame, value: str, classes: int) -> DataFrame:
    """Upper bounds of `classes` classes of least squared deviation: an exact dynamic program over all distinct values.

    Of n levels the best last break before a level never lies lower than that of a lower level. So for each class a few
    levels are tried against all, then FAN times as many between those, each only against the levels between the breaks of
    its neighbours, and so on: about FAN n log n pairs a class, as equality joins on blocks of levels. Values are centred
    first, so squares of large values do not cancel. Equal costs take the lower breaks.
    """
    v = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    levels = v.groupBy("v").agg(F.count("*").alias("w"))
    n, mean = levels.agg(F.count("*"), F.sum(F.col("v") * F.col("w")) / F.sum("w")).first()
    if not n:
        return v.select(F.lit(0).alias("class"), F.col("v").alias("upper"))
    root, classes = max(2, math.isqrt(n)), min(classes, n)
    fan = root if n <= TWO_STEPS else FAN
    strides = [1]
    while strides[-1] * fan < n:
        strides.append(strides[-1] * fan)
    c = written(_levels(levels, mean))
    best = c.select("i", (F.col("ss") - F.col("s") * F.col("s") / F.col("n")).alias("cost"), F.array("v").alias("breaks"))
    for _ in range(classes - 1):
        left = written(best.join(c, "i").select(F.col("i").alias("j"), "cost", "breaks", F.col("n").alias("n0"), F.col("s").alias("s0"), F.col("ss").alias("ss0")))
        found, wide = None, 0
        for stride in reversed(strides):
            if found is None:
                rows = c.where((F.col("i") % stride == 0) | (F.col("i") == n)).withColumn("_low", F.lit(1).cast("long")).withColumn("_high", F.col("i") - 1)
            else:
                known = found.select(F.col("i").alias("_i"), F.col("j").alias("_j"))
                last = known.where(F.col("_i") == n).select(F.col("_j").alias("_last"))  # one row
                below = known.where(F.col("_i") % wide == 0).select((F.col("_i") / wide).cast("long").alias("_at"), F.col("_j").alias("_low"))
                above = below.select((F.col("_at") - 1).alias("_at"), F.col("_low").alias("_high"))
                rows = c.where((F.col("i") % stride == 0) & (F.col("i") % wide != 0) & (F.col("i") != n)).withColumn("_at", F.floor(F.col("i") / wide))
                rows = rows.join(below, "_at", "left").join(above, "_at", "left").crossJoin(F.broadcast(last)).drop("_at")
                rows = rows.withColumn("_low", F.coalesce("_low", F.lit(1))).withColumn("_high", F.least(F.coalesce("_high", "_last"), F.col("i") - 1)).drop("_last")
            block = max(fan, min(stride * fan, 4 * root))
            step = written(_best_break(rows, left, block))
            found, wide = step if found is None else found.unionByName(step), stride
        best = found.drop("j")
    return best.where(F.col("i") == n).select(F.posexplode("breaks").alias("class", "upper"))


def _levels(levels: DataFrame, mean: float) -> DataFrame:
    """v, its rank i from 1, and sums over all levels up to it: n of weights, s of centred values, ss of their squares. Sorted by ranges, no task holds all."""
    part = written(levels.repartitionByRange("v").withColumn("_p", F.spark_partition_id()).withColumn("d", F.col("v") - F.lit(mean)))
    upto = Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    sums = {"i": F.lit(1), "n": F.col("w"), "s": F.col("d") * F.col("w"), "ss": F.col("d") * F.col("d") * F.col("w")}
    totals = part.groupBy("_p").agg(*(F.sum(x).alias(f"_{k}") for k, x in sums.items()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = totals.select("_p", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums))
    return part.join(F.broadcast(totals), "_p").select("v", *((F.col(f"_{k}") + F.sum(x).over(upto)).alias(k) for k, x in sums.items()))


def _best_break(at: DataFrame, left: DataFrame, block: int) -> DataFrame:
    """i, j, cost and breaks of the best last break j from _low to _high of each level; the two meet in blocks of `block` levels."""
    of = lambda c: F.floor((F.col(c) - 1) / block)
    ranged = at.where("_low <= _high").select("i", "v", "n", "s", "ss", "_low", "_high", F.explode(F.sequence(of("_low"), of("_high"))).alias("block"))
    pairs = ranged.join(left.withColumn("block", of("j")), "block").where("j BETWEEN _low AND _high")
    n, s, ss = F.col("n") - F.col("n0"), F.col("s") - F.col("s0"), F.col("ss") - F.col("ss0")
    return pairs.withColumn("total", F.col("cost") + ss - s * s / n).groupBy("i", "v").agg(F.min("total").alias("cost"), F.min_by(F.struct("j", "breaks"), F.struct("total", "j")).alias("b")).select("i", F.col("b.j").alias("j"), "cost", F.concat("b.breaks", F.array("v")).alias("breaks"))
