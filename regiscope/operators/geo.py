"""Points, grids and polygon overlap in planar metres, all as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.operators.agg import at_group_max, share_of_group, share_true

SQRT3 = math.sqrt(3.0)


def bounding_box(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: x0, y0, x1, y1."""
    return df.agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"))


def square_cells(df: DataFrame, x: str, y: str, size: float, edges: str = "half_open") -> DataFrame:
    """Adds ix, iy and cell (iy * columns + ix + 1) of a square grid over the data's extent.

    Cells hold their lower edges, the last ones also their upper edge; edges="both" repeats a point that
    lies on an inner edge for each cell that it touches.
    """
    boxed = df.crossJoin(F.broadcast(bounding_box(df, x, y)))  # one row
    nx = F.greatest(F.lit(1), F.ceil((F.col("x1") - F.col("x0")) / size))
    ny = F.greatest(F.lit(1), F.ceil((F.col("y1") - F.col("y0")) / size))
    for c, low, n, name in ((x, "x0", nx, "ix"), (y, "y0", ny, "iy")):
        at = (F.col(c) - F.col(low)) / size
        if edges == "both":
            whole = F.floor(at)
            cells = F.array_distinct(F.array(F.when((at == whole) & (whole > 0), whole - 1).otherwise(whole), F.least(whole, n - 1)))
            boxed = boxed.withColumn(name, F.explode(cells))
        else:
            boxed = boxed.withColumn(name, F.least(F.floor(at), n - 1))
    return boxed.withColumn("cell", F.col("iy") * nx + F.col("ix") + 1).drop("x0", "y0", "x1", "y1")


def hex_cells(df: DataFrame, x: str, y: str, size: float, origin: tuple[float, float] | None = None) -> DataFrame:
    """Adds q and r, axial coordinates of the pointy-top hexagon (flat to flat `size`) of each point."""
    edge = size / SQRT3
    if origin is None:
        boxed = df.crossJoin(F.broadcast(bounding_box(df, x, y)))
        dx, dy = F.col(x) - F.col("x0"), F.col(y) - F.col("y0")
    else:
        boxed, dx, dy = df, F.col(x) - origin[0], F.col(y) - origin[1]
    fq, fr = (dx * (SQRT3 / 3) - dy / 3) / edge, dy * (2 / 3) / edge
    boxed = boxed.withColumn("_q", fq).withColumn("_r", fr)
    rq, rr, rs = F.floor(F.col("_q") + 0.5), F.floor(F.col("_r") + 0.5), F.floor(-F.col("_q") - F.col("_r") + 0.5)
    eq, er, es = F.abs(rq - F.col("_q")), F.abs(rr - F.col("_r")), F.abs(rs + F.col("_q") + F.col("_r"))
    q = F.when((eq > er) & (eq > es), -rr - rs).otherwise(rq)
    r = F.when((eq > er) & (eq > es), rr).when(er > es, -rq - rs).otherwise(rr)
    return boxed.withColumn("q", q).withColumn("r", r).drop("_q", "_r", "x0", "y0", "x1", "y1")


def hex_centre(q: Column, r: Column, size: float) -> tuple[Column, Column]:
    """Centre relative to the grid's origin."""
    edge = size / SQRT3
    return edge * SQRT3 * (q + r / 2), edge * 1.5 * r


def square_corners(ix: Column, iy: Column, size: float) -> Column:
    """Closed ring of a cell relative to the grid's origin."""
    x, y = ix * size, iy * size
    return F.array(*(F.array((x + a * size).cast("double"), (y + b * size).cast("double")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))


def hex_corners(q: Column, r: Column, size: float) -> Column:
    """Closed ring of a hexagon relative to the grid's origin, from its top corner clockwise."""
    edge = size / SQRT3
    x, y = hex_centre(q, r, size)
    turns = [math.pi / 2 - k * math.pi / 3 for k in range(6)] + [math.pi / 2]
    return F.array(*(F.array(x + edge * math.cos(t), y + edge * math.sin(t)) for t in turns))


def distance(x1: str, y1: str, x2: str, y2: str) -> Column:
    dx, dy = F.col(x1) - F.col(x2), F.col(y1) - F.col(y2)
    return F.sqrt(dx * dx + dy * dy)


# ---------------------------------------------------------------- polygons: parts array<array<array<struct<x,y>>>>, each an outer ring and its holes


def boxed(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Adds x0, y0, x1, y1: the box around all corners."""
    flat = F.flatten(F.flatten(F.col(parts)))
    of = lambda c: F.transform(flat, lambda p: p[c])
    return df.withColumn("x0", F.array_min(of("x"))).withColumn("y0", F.array_min(of("y"))).withColumn("x1", F.array_max(of("x"))).withColumn("y1", F.array_max(of("y")))


def edges(df: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """key, sign and the ends (ax, ay), (bx, by), ax < bx, of every edge that isn't upright.

    Signs are so that a point is in the polygon as often as edges above it count: 1 along the top of an outer ring, -1
    along its bottom, the other way round for holes, in whatever direction rings run. Rings may or may not repeat their first corner.
    """
    part = df.select(key, F.explode(parts).alias("_rings"))
    ring = part.select(key, F.posexplode("_rings").alias("_k", "_ring"))
    follow = F.concat(F.slice("_ring", F.lit(2), F.size("_ring")), F.slice("_ring", 1, 1))
    pair = ring.withColumn("_pair", F.arrays_zip(F.col("_ring").alias("a"), follow.alias("b")))
    twice = F.aggregate("_pair", F.lit(0.0), lambda s, p: s + (p["b"]["x"] - F.col("_ring")[0]["x"]) * (p["a"]["y"] - F.col("_ring")[0]["y"]) - (p["a"]["x"] - F.col("_ring")[0]["x"]) * (p["b"]["y"] - F.col("_ring")[0]["y"]))
    turned = pair.withColumn("_turn", F.when((twice > 0) == (F.col("_k") == 0), 1).otherwise(-1)).select(key, "_turn", F.explode("_pair").alias("p"))  # 1: an outer ring that runs clockwise, or a hole that does not
    right = F.col("p.a.x") < F.col("p.b.x")
    end = lambda c, first: F.when(right == F.lit(first), F.col(f"p.a.{c}")).otherwise(F.col(f"p.b.{c}"))
    sign = F.col("_turn") * F.when(right, 1).otherwise(-1)
    return turned.where("p.a.x <> p.b.x").select(key, sign.alias("sign"), end("x", True).alias("ax"), end("y", True).alias("ay"), end("x", False).alias("bx"), end("y", False).alias("by"))


def _tiles(low: str, high: str, size: float) -> Column:
    return F.explode(F.sequence(F.floor(F.col(low) / size).cast("long"), F.floor(F.col(high) / size).cast("long")))


def _at(x: Column, side: str) -> Column:
    """Height of an edge at x."""
    ax, ay, bx, by = (F.col(f"{side}{c}") for c in ("ax", "ay", "bx", "by"))
    return ay + (by - ay) * ((x - ax) / (bx - ax))


def overlaps(larger: DataFrame, smaller: DataFrame, large_id: str, small_id: str, tile: float) -> DataFrame:
    """(large, small, area) of polygons of any shape that share area; both tables have their id and `parts`.

    Pairs meet by tile and go unless their boxes overlap. The area common to two polygons is the sum over pairs of their
    edges of the signed area under the lower of the two, which is a formula of their ends; edges meet by strips of x, cut
    at strip borders, so no task compares all edges of two polygons, and only numbers travel, not rings.
    """
    sides = {}
    for side, df, key in (("l", larger, large_id), ("s", smaller, small_id)):
        sides[side] = df.select(F.col(key).alias(side), "parts")
    box = {k: boxed(v).select(k, *(F.col(c).alias(k + c) for c in ("x0", "y0", "x1", "y1"))) for k, v in sides.items()}
    tiled = {k: v.withColumn("tx", _tiles(k + "x0", k + "x1", tile)).withColumn("ty", _tiles(k + "y0", k + "y1", tile)) for k, v in box.items()}
    apart = (F.col("lx0") < F.col("sx1")) & (F.col("sx0") < F.col("lx1")) & (F.col("ly0") < F.col("sy1")) & (F.col("sy0") < F.col("ly1"))
    pairs = tiled["l"].join(tiled["s"], ["tx", "ty"]).where(apart).select("l", "s", F.least("ly0", "sy0").alias("base"), F.greatest("lx0", "sx0").alias("from"), F.least("lx1", "sx1").alias("to")).distinct()
    strips = pairs.withColumn("strip", _tiles("from", "to", tile))
    cut = {}
    for k, v in sides.items():
        e = edges(v, k).withColumn("strip", _tiles("ax", "bx", tile))
        cut[k] = e.select(k, "strip", *(F.col(c).alias(k + c) for c in ("sign", "ax", "ay", "bx", "by")))
    met = strips.join(cut["s"], ["s", "strip"]).join(cut["l"], ["l", "strip"])
    low = F.greatest("lax", "sax", F.col("strip") * tile)
    high = F.least("lbx", "sbx", (F.col("strip") + 1) * tile)
    met = met.withColumn("u", low).withColumn("v", high).where("u < v")
    for end in ("u", "v"):
        met = met.withColumn(f"f{end}", _at(F.col(end), "l") - F.col("base")).withColumn(f"g{end}", _at(F.col(end), "s") - F.col("base"))
    du, dv = F.col("fu") - F.col("gu"), F.col("fv") - F.col("gv")
    plain = F.when(du + dv <= 0, F.col("fu") + F.col("fv")).otherwise(F.col("gu") + F.col("gv")) * (F.col("v") - F.col("u")) / 2
    # where they cross, the lower one changes at the share du / (du - dv) of the way
    t = du / (du - dv)
    mid = F.col("fu") + t * (F.col("fv") - F.col("fu"))
    crossed = ((F.least("fu", "gu") + mid) * t + (mid + F.least("fv", "gv")) * (1 - t)) * (F.col("v") - F.col("u")) / 2
    under = F.when(du * dv < 0, crossed).otherwise(plain)
    out = met.groupBy("l", "s").agg(F.sum(F.col("lsign") * F.col("ssign") * under).alias("area"))
    return out.where("area > 1e-9").select(F.col("l").alias("large"), F.col("s").alias("small"), "area")


def largest_overlap(larger: DataFrame, smaller: DataFrame, large_id: str, small_id: str, tile: float, digits: int = 6) -> DataFrame:
    """For each smaller polygon the larger ones with the greatest share of its summed overlaps (ties stay), rounded to `digits`."""
    shared = share_of_group(overlaps(larger, smaller, large_id, small_id, tile), ["small"], "area").withColumn("pct", F.round("pct", digits))
    return at_group_max(shared, ["small"], "pct")


def share_inside(found: DataFrame) -> DataFrame:
    """One row: per cent of the rows of `largest_overlap` that lie fully in their larger polygon."""
    return found.agg(share_true(F.col("pct") == 100).alias("fully_inside"))
