"""Repairing, checking and clipping the rings of polygon layers, in array functions: a polygon is one row and meets no other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import OUTSIDE, edges_of, ray_expression, segment_cells, side_expression


def signed_area(ring: str) -> str:
    """SQL for the area of a closed ring: positive if it runs counter-clockwise."""
    return f"aggregate(sequence(2, size({ring})), 0D, (s, i) -> s + (element_at({ring}, i - 1).x * element_at({ring}, i).y - element_at({ring}, i).x * element_at({ring}, i - 1).y)) / 2"


def area(rings: str = "rings") -> Column:
    """The area of rings whose shells run counter-clockwise and whose holes run clockwise."""
    return F.expr(f"aggregate({rings}, 0D, (total, ring) -> total + {signed_area('ring')})")


def repair_rings(segments: DataFrame) -> DataFrame:
    """The layer with rings in one form: closed, without points twice in a row, from the least point on (by x, then y), larger rings first.

    A ring inside an odd number of the polygon's others is a hole and runs clockwise, any other counter-clockwise, whatever way it was
    drawn. Rings of fewer than three points, or of points on one line, go; points without a coordinate are left out. A polygon without a ring keeps its row. Edges that cross are
    not moved: ``ring_crossings`` lists them.
    """
    least = "cast(array_position(ring, array_min(ring)) AS int)"
    bend = "(ring[i].x - ring[0].x) * (ring[i + 1].y - ring[0].y) <> (ring[i].y - ring[0].y) * (ring[i + 1].x - ring[0].x)"
    steps = (
        "transform(coalesce(rings, array()), ring -> filter(ring, p -> p.x IS NOT NULL AND p.y IS NOT NULL))",
        # Points twice in a row, also last and first, count once.
        "transform(rings, ring -> filter(ring, (p, i) -> p <> ring[if(i = 0, size(ring) - 1, i - 1)]))",
        f"transform(filter(rings, ring -> size(ring) > 2), ring -> concat(slice(ring, {least}, size(ring)), slice(ring, 1, {least} - 1)))",
        "transform(rings, ring -> concat(ring, array(ring[0])))",
        f"filter(rings, ring -> exists(sequence(1, size(ring) - 3), i -> {bend}))",
    )
    out = segments
    for step in steps:
        out = out.withColumn("rings", F.expr(step))
    inside = ray_expression("ring[0].x", "ring[0].y", "edges[j]")
    depth = f"size(filter(sequence(0, size(rings) - 1), j -> j <> i AND {inside}))"
    # From the least point on, backwards too.
    turned = "concat(array(o.ring[0]), reverse(slice(o.ring, 2, size(o.ring) - 2)), array(o.ring[0]))"
    return (
        out.withColumn("edges", F.transform("rings", lambda r: edges_of(F.array(r))))
        .withColumn("rings", F.expr(f"transform(rings, (ring, i) -> named_struct('size', -abs({signed_area('ring')}), 'ring', ring, 'hole', {depth} % 2 = 1, 'left', {signed_area('ring')} > 0))"))
        .withColumn("rings", F.expr(f"transform(array_sort(rings), o -> if(o.hole = o.left, {turned}, o.ring))"))
        .select(*segments.columns)
    )


def ring_crossings(segments: DataFrame, most_edges: int = 16) -> DataFrame:
    """(bay_segment, first, second): pairs of a polygon's edges that cross at a point inside both. Edges that only touch are not listed.

    Edges meet in the leaves of the layer's cell tree, a few each, and are tested exactly.
    """
    cells = segment_cells(segments, most_edges)
    parts = cells.leaves.where(F.col("level") != OUTSIDE).select(F.explode("candidates").alias("c")).select("c.bay_segment", "c.edges").where(F.size("edges") > 1)

    def apart(e: str, other: str) -> str:
        return f"{side_expression(e, f'{other}.ax', f'{other}.ay')} * {side_expression(e, f'{other}.bx', f'{other}.by')} < 0"

    pairs = f"flatten(transform(edges, (e, i) -> transform(filter(slice(edges, i + 2, size(edges)), o -> {apart('e', 'o')} AND {apart('o', 'e')}), o -> named_struct('first', least(e, o), 'second', greatest(e, o)))))"
    return parts.select("bay_segment", F.explode(F.expr(pairs)).alias("p")).select("bay_segment", "p.first", "p.second").distinct()


def clip_rings(segments: DataFrame, box: DataFrame) -> DataFrame:
    """The layer cut to a box (one row: xmin, ymin, xmax, ymax): each ring is cut by the four sides in turn, and rings outside go.

    A ring that leaves the box and comes back keeps one outline, which runs along the side between; areas and points inside are right. Polygons of which
    nothing is left go too. Rings are closed, as ``repair_rings`` gives them.
    """
    limits = box.select(*[F.col(c).alias(f"_{c}") for c in ("xmin", "ymin", "xmax", "ymax")])
    # One row of numbers, as scalar subqueries: nothing is joined.
    out = segments.withColumns({c: limits.select(c).scalar() for c in limits.columns})
    for axis, other, limit, keeps in (("x", "y", "_xmin", ">="), ("x", "y", "_xmax", "<="), ("y", "x", "_ymin", ">="), ("y", "x", "_ymax", "<=")):
        a, b = "r[i - 1]", "r[i]"
        at = f"({a}.{other} + ({b}.{other} - {a}.{other}) * (({limit} - {a}.{axis}) / ({b}.{axis} - {a}.{axis})))"
        met = f"named_struct('x', {limit}, 'y', {at})" if axis == "x" else f"named_struct('x', {at}, 'y', {limit})"
        inner = [f"{p}.{axis} {keeps} {limit}" for p in (a, b)]
        kept = f"CASE WHEN {inner[0]} AND {inner[1]} THEN array({b}) WHEN {inner[0]} THEN array({met}) WHEN {inner[1]} THEN array({met}, {b}) ELSE slice(r, 1, 0) END"
        cut = f"transform(rings, r -> if(size(r) = 0, r, flatten(transform(sequence(1, size(r) - 1), i -> {kept}))))"
        closed = "transform(filter(rings, r -> size(r) > 0), r -> if(r[0] = element_at(r, -1), r, concat(r, array(r[0]))))"
        out = out.withColumn("rings", F.expr(cut)).withColumn("rings", F.expr(closed))
    out = out.withColumn("rings", F.expr(f"filter(rings, r -> size(r) > 3 AND {signed_area('r')} <> 0)"))
    return out.where(F.size("rings") > 0).select(*segments.columns)
