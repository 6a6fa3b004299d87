"""Point in polygon by a tree of square cells and an exact side test.

Cells are squares whose sides are powers of two, so the cell of a coordinate is exact arithmetic. At most four top cells cover the layer;
a cell is split into four while more than a few edges pass through it. A cell knows for each polygon near it
the edges that touch it and whether its lower right corner lies inside. What holds for any other point of the cell follows from the edges between
the point and that corner, along a level and then an upright line inside the cell: cells wholly inside a polygon answer without
an edge, and the number of cells grows with the length of the boundaries, not with the area of the layer.

Every point of the top cells lies in exactly one leaf, so looking a point up is an equi-join on (level, column, row) that matches one row.

A point counts as if it lay a little to the right of its place, and by still less above it. So it lies in one
of two polygons that share an edge, a point on a lower or left edge is inside, and one on an upper or right edge outside. The side of an
edge is the sign of a product sum whose rounding error is bounded; where the bound does not decide, the sum is worked out exactly.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle

# A cell with more edges is split, but not deeper than this.
MOST_EDGES = 16
DEEPEST = 20
# Bounds of the rounding error of the side test, relative to the sum of its two products' sizes.
SURE = 4e-16
CLEAR = 1e-14
# Splits a double into two halves whose products are exact.
HALVES = 134217729
# The cell of points outside the top cells.
OUTSIDE = -1


class Cells(NamedTuple):
    """A layer's leaves (level, cell_x, cell_y, candidates), the levels they have, and the top cells' side and range (None for an empty layer)."""

    leaves: DataFrame
    levels: list[int]
    side: float
    range: tuple[int, int, int, int] | None


def edges_of(rings: Column) -> Column:
    """All edges of some closed rings, lower end first; level ones are kept, since upright lines cross them."""

    def upward(a: Column, b: Column) -> Column:
        low, high = F.when(a["y"] <= b["y"], a).otherwise(b), F.when(a["y"] <= b["y"], b).otherwise(a)
        return F.struct(low["x"].alias("ax"), low["y"].alias("ay"), high["x"].alias("bx"), high["y"].alias("by"))

    def of_ring(ring: Column) -> Column:
        last = F.size(ring) - 1
        pairs = F.arrays_zip(F.slice(ring, 1, last).alias("a"), F.slice(ring, 2, last).alias("b"))
        return F.transform(pairs, lambda p: upward(p["a"], p["b"]))

    edges = F.flatten(F.transform(rings, of_ring))
    return F.filter(edges, lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))


# One product of two doubles as two doubles, what rounding lost and the rounded product; ``q`` holds the factors and their upper halves.
_PRODUCT = "array((q.a - q.ah) * (q.b - q.bh) - (((q.a * q.b - q.ah * q.bh) - (q.a - q.ah) * q.bh) - q.ah * (q.b - q.bh)), q.a * q.b)"
_HALVES = f"named_struct('a', f.a, 'b', f.b, 'ah', {HALVES}D * f.a - ({HALVES}D * f.a - f.a), 'bh', {HALVES}D * f.b - ({HALVES}D * f.b - f.b))"
# The rounded sum ``t`` of the running total and one part goes on, what rounding lost joins the parts.
_ADD = (
    "transform(array(named_struct('t', s.total + p, 'v', s.total + p - s.total)), "
    "r -> named_struct('total', r.t, 'parts', concat(s.parts, array((s.total - (r.t - r.v)) + (p - r.v)))))[0]"
)
_NONE = "cast(array() AS array<double>)"


def _exact(e: str, x: str, y: str) -> str:
    """The sign of the side test without rounding: its six products, each as two doubles, summed into parts that do not overlap."""
    pairs = ((f"{e}.bx", y), (f"-{e}.bx", f"{e}.ay"), (f"-{e}.ax", y), (f"-{e}.by", x), (f"{e}.by", f"{e}.ax"), (f"{e}.ay", x))
    factors = ", ".join(f"named_struct('a', {a}, 'b', {b})" for a, b in pairs)
    terms = f"flatten(transform(transform(array({factors}), f -> {_HALVES}), q -> {_PRODUCT}))"
    grown = f"aggregate({terms}, {_NONE}, (held, w) -> aggregate(held, named_struct('total', w, 'parts', {_NONE}), (s, p) -> {_ADD}, s -> concat(s.parts, array(s.total))))"
    return f"coalesce(signum(get(reverse(filter({grown}, v -> v <> 0)), 0)), 0D)"


def exact_sign(edge: str, x: str, y: str) -> Column:
    """The sign of the side test of a point and the line of an upward edge, without rounding: 1 left of it, 0 on it, -1 right of it."""
    return F.expr(_exact(edge, x, y))


def _products(e: str, x: str, y: str) -> tuple[str, str]:
    return f"(({e}.bx - {e}.ax) * ({y} - {e}.ay))", f"(({e}.by - {e}.ay) * ({x} - {e}.ax))"


def side_expression(e: str, x: str, y: str) -> str:
    """SQL for the side of an upward edge's line that a point lies on: 1 left, -1 right, 0 on it."""
    one, other = _products(e, x, y)
    return f"if(abs({one} - {other}) > {SURE}D * (abs({one}) + abs({other})), signum({one} - {other}), {_exact(e, x, y)})"


def error_bound(side: float) -> str:
    """SQL for what rounding may add to the side test of any point and edge of a layer whose top cells have this side."""
    return f"{2e-15 * side * side}D"


def _left(e: str, x: str, y: str, bound: str) -> str:
    """True for a point strictly to the left of an upward edge's line."""
    one, other = _products(e, x, y)
    return f"({one} - {other} > {bound} OR ({one} - {other} >= -{bound} AND {_exact(e, x, y)} > 0))"


def _inside(x: str, y: str, right: str, bottom: str, corner: str, edges: str, bound: str) -> str:
    """Whether a point of a cell is inside, from whether the cell's lower right corner is, and the edges that touch the cell.

    Each edge that passes between the two, along the level to (right, y) and the upright line from there to the corner, changes it.
    """
    here, turn, end = (_left("e", *place, bound) for place in ((x, y), (right, y), (right, bottom)))
    level = f"(e.ay <= {y} AND {y} < e.by AND {here} AND NOT {turn})"
    spans = f"least(e.ax, e.bx) <= {right} AND {right} < greatest(e.ax, e.bx)"
    upright = f"({spans} AND if(e.ay = e.by, ({y} >= e.ay) <> ({bottom} >= e.ay), {turn} <> {end}))"
    return f"aggregate({edges}, {corner}, (inner, e) -> inner <> ({level} <> {upright}))"


def candidates_at(x: str, y: str, right: str, bottom: str, bound: str) -> Column:
    """Names of a cell's candidates that hold the point."""
    return F.expr(f"transform(filter(candidates, c -> {_inside(x, y, right, bottom, 'c.corner', 'c.edges', bound)}), c -> c.bay_segment)")


def ray_expression(x: str, y: str, edges: str, bound: str | None = None) -> str:
    """SQL for whether a point is inside, from all edges of a polygon: a level ray to the right crosses an odd number."""
    left = _left("e", x, y, bound) if bound else f"{side_expression('e', x, y)} > 0"
    return f"aggregate({edges}, false, (inner, e) -> inner <> (e.ay <= {y} AND {y} < e.by AND {left}))"


def _touching(edges: str, x0: str, y0: str, x1: str, y1: str) -> Column:
    """Every edge that touches the closed box, and few others: the boxes meet, and the corners are not all clearly on one side."""
    meet = f"least(e.ax, e.bx) <= {x1} AND greatest(e.ax, e.bx) >= {x0} AND e.ay <= {y1} AND e.by >= {y0}"
    one, other = _products("e", "z.x", "z.y")
    side = f"if({one} - {other} > {CLEAR}D * (abs({one}) + abs({other})), 1, if({other} - {one} > {CLEAR}D * (abs({one}) + abs({other})), -1, 0))"
    corners = ", ".join(f"named_struct('x', {x}, 'y', {y})" for x in (x0, x1) for y in (y0, y1))
    return F.expr(f"filter({edges}, e -> {meet} AND abs(aggregate(array({corners}), 0, (n, z) -> n + {side})) < 4)")


def cell_of(coordinate: Column, side: Column | float) -> Column:
    return F.floor(coordinate / (side if isinstance(side, Column) else F.lit(float(side))))


def _with_box(frame: DataFrame, side: float) -> DataFrame:
    """The cell's box as columns x0, y0, x1, y1."""
    x, y, width = F.col("cell_x"), F.col("cell_y"), F.lit(side)
    return frame.withColumns({"x0": x * width, "y0": y * width, "x1": (x + 1) * width, "y1": (y + 1) * width})


BOX = ("x0", "y0", "x1", "y1")


def _parts_of(whole: DataFrame, side: float) -> DataFrame:
    """The parts that polygons have in the top cells."""
    corner = F.expr(ray_expression("x1", "y0", "edges", error_bound(side))).alias("corner")
    return _counted(_with_box(whole, side).select("bay_segment", "cell_x", "cell_y", corner, _touching("edges", *BOX).alias("edges")))


def _counted(parts: DataFrame) -> DataFrame:
    """With the number of edges, so that cells are counted without reading any."""
    return parts.withColumn("n", F.size("edges"))


def _split(parts: DataFrame, side: float, bound: str) -> DataFrame:
    """The parts of polygons in the four children of each cell; ``side`` is the parent's."""
    quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    parents = _with_box(parts, side).select("bay_segment", "corner", "edges", F.col("x1").alias("right"), F.col("y0").alias("bottom"), "cell_x", "cell_y", quarter.alias("q"))
    children = parents.withColumns({"cell_x": F.col("cell_x") * 2 + F.col("q.i"), "cell_y": F.col("cell_y") * 2 + F.col("q.j")})
    corner = F.expr(_inside("x1", "y0", "right", "bottom", "corner", "edges", bound)).alias("corner")
    return _counted(_with_box(children, side / 2).select("bay_segment", "cell_x", "cell_y", corner, _touching("edges", *BOX).alias("edges")))


def segment_cells(segments: DataFrame, most_edges: int = MOST_EDGES, deepest: int = DEEPEST) -> Cells:
    """The cell tree of a polygon layer (bay_segment, rings of closed points). Build it once for a layer that serves several calls.

    Each level is written: the parts of polygons in its cells. A polygon's part is a row of its own, so no row
    and no task holds more than one polygon's edges before a cell is a leaf.
    """
    points = F.flatten("rings")
    xs, ys = F.transform(points, lambda v: v["x"]), F.transform(points, lambda v: v["y"])
    bounds = segments.agg(
        F.min(F.array_min(xs)).alias("x0"), F.max(F.array_max(xs)).alias("x1"), F.min(F.array_min(ys)).alias("y0"), F.max(F.array_max(ys)).alias("y1")
    ).first()
    spark = segments.sparkSession
    nowhere = spark.range(1).select(F.lit(OUTSIDE).alias("level"), F.lit(0).cast("long").alias("cell_x"), F.lit(0).cast("long").alias("cell_y"))
    none = F.array().cast("array<struct<bay_segment:string,corner:boolean,edges:array<struct<ax:double,ay:double,bx:double,by:double>>>>")
    if bounds is None or bounds["x0"] is None:
        return Cells(nowhere.withColumn("candidates", none), [], 1.0, None)
    # A power of two not below the layer's extent: two columns and two rows of cells suffice.
    extent = max(bounds["x1"] - bounds["x0"], bounds["y1"] - bounds["y0"])
    top = side = 2.0 ** math.frexp(extent)[1] if extent > 0 else 1.0
    held = tuple(math.floor(bounds[name] / side) for name in ("x0", "x1", "y0", "y1"))
    columns, rows = (F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long"))) for a, b in (held[:2], held[2:]))
    whole = segments.select("bay_segment", edges_of(F.col("rings")).alias("edges")).withColumn("cell_x", columns).withColumn("cell_y", rows)
    parts = settle(_parts_of(whole, side), "cell-parts")
    leaves, levels = [], []
    for level in range(deepest + 1):
        busy = parts.groupBy("cell_x", "cell_y").agg(F.sum("n").alias("n")).where(F.col("n") > most_edges).drop("n")
        done = level == deepest or busy.isEmpty()
        here = parts if done else parts.join(busy, ["cell_x", "cell_y"], "left_anti")
        leaves.append(here.select(F.lit(level).alias("level"), "cell_x", "cell_y", "bay_segment", "corner", "edges"))
        levels.append(level)
        if done:
            break
        # What lies outside a polygon is left to the parts that split the cell.
        open_parts = parts.join(busy, ["cell_x", "cell_y"], "left_semi").where((F.col("n") > 0) | F.col("corner"))
        parts = settle(_split(open_parts, side, error_bound(top)), "cell-parts")
        side /= 2
    every = leaves[0]
    for more in leaves[1:]:
        every = every.union(more)
    near = F.when((F.size("edges") > 0) | F.col("corner"), F.struct("bay_segment", "corner", "edges"))
    gathered = every.groupBy("level", "cell_x", "cell_y").agg(F.collect_list(near).alias("candidates"))
    written = settle(gathered.unionByName(nowhere.withColumn("candidates", none)), "segment-cells")
    return Cells(written, levels, top, held)


def levels_of(x: Column, y: Column, cells: Cells) -> Column:
    """The levels, with their cells' side, at which a point may have its leaf; one mark for a point outside the top cells or without a place."""
    mark = F.array(F.struct(F.lit(OUTSIDE).alias("level"), F.lit(0.0).alias("side")))
    if cells.range is None:
        return mark
    x0, x1, y0, y1 = cells.range
    listed = F.array(*[F.struct(F.lit(level).alias("level"), F.lit(cells.side / 2**level).alias("side")) for level in cells.levels])
    covered = ~F.isnan(x) & ~F.isnan(y) & cell_of(x, cells.side).between(x0, x1) & cell_of(y, cells.side).between(y0, y1)
    return F.when(covered, listed).otherwise(mark)
