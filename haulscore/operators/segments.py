"""Bay segments of sampling sites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CONDITIONAL_BELOW, CONDITIONAL_GRID, CONDITIONAL_SEGMENT, GRID_SEGMENTS, OUTER_SEGMENTS
from ..functions.geometry import MOST_EDGES, OUTSIDE, Cells, candidates_at, cell_of, error_bound, levels_of, segment_cells
from ..runtime import lookup_join

SITE_KEYS = ("Reference", "Zone", "Grid")


def assign_segments(sites: DataFrame, segments: DataFrame | Cells, most_edges: int = MOST_EDGES) -> DataFrame:
    """Add the segment each site lies in; NULL outside all of them, one row per segment where they overlap.

    ``segments`` is the polygon layer, or its cells where one layer serves several calls. A cell of the layer with more than
    ``most_edges`` edges is split; the result does not depend on it.
    """
    cells = segments if isinstance(segments, Cells) else segment_cells(segments, most_edges)
    x, y = F.col("Longitude"), F.col("Latitude")
    # A site asks for a cell at each level of the tree and finds one of them.
    asked = sites.withColumn("_at", F.explode(levels_of(x, y, cells))).withColumns({"level": F.col("_at.level"), "_side": F.col("_at.side")})
    column, row = (F.when(F.col("level") == OUTSIDE, 0).otherwise(cell_of(v, F.col("_side"))) for v in (x, y))
    placed = asked.select(*sites.columns, "level", "_side", column.alias("cell_x"), row.alias("cell_y"))
    names = candidates_at("Longitude", "Latitude", "((cell_x + 1) * _side)", "(cell_y * _side)", error_bound(cells.side))
    return lookup_join(placed, cells.leaves, ["level", "cell_x", "cell_y"], "inner").select(*sites.columns, F.explode_outer(names).alias("bay_segment"))


def override_segments(
    sites: DataFrame,
    grid_segments: Mapping[int, str] = GRID_SEGMENTS,
    conditional_grid: int = CONDITIONAL_GRID,
    conditional_segment: str = CONDITIONAL_SEGMENT,
    axis: str = "x",
    below: float = CONDITIONAL_BELOW,
    excluded: Sequence[str] = OUTER_SEGMENTS,
) -> DataFrame:
    """Set the segment of some grids by hand, then drop sites outside the main segments.

    The rule of ``conditional_grid`` compares the coordinate along ``axis``. The default ``x`` gives
    the published scores; the rule's stated intent is ``y``.
    """
    coordinate = F.col({"x": "Longitude", "y": "Latitude"}[axis])
    rules = [(F.col("Grid") == grid, F.lit(name)) for grid, name in grid_segments.items()]
    rules.append(((F.col("Grid") == conditional_grid) & (coordinate < below), F.lit(conditional_segment)))
    by_hand = F.when(*rules[0])
    for rule in rules[1:]:
        by_hand = by_hand.when(*rule)
    return sites.withColumn("bay_segment", by_hand.otherwise(F.col("bay_segment"))).filter(
        F.col("bay_segment").isNotNull() & ~F.col("bay_segment").isin(*excluded)
    )


def _as_condition(test: Column) -> Column:
    return F.exists(F.array(F.lit(True)), lambda _: test)


def attach_segments(catch: DataFrame, sites: DataFrame, null_references: bool = True) -> DataFrame:
    """Catch records of the given sites with their segment, and one bare row per site without records.

    A NULL zone or grid matches a NULL one; so does a NULL reference, unless ``null_references`` is off. Then the reference alone is the
    key of the joins, and tables that are stored by it are joined where they lie. The matched part is an inner join, so adaptive execution can
    split a hot haul on either side, which it could not do on the inner side of an outer join.
    """
    right = sites.select(*SITE_KEYS, "bay_segment")

    def same(left: str) -> Column:
        tests = {k: F.col(f"{left}.{k}").eqNullSafe(F.col(f"s.{k}")) for k in SITE_KEYS}
        if not null_references:
            # Inside a lambda an equality is a condition on the joined rows, not one more key to shuffle by.
            tests = {k: _as_condition(test) for k, test in tests.items()}
            tests["Reference"] = F.col(f"{left}.Reference") == F.col("s.Reference")
        return reduce(lambda a, b: a & b, tests.values())

    columns = [F.col(f"c.{c}") for c in catch.columns]
    matched = catch.alias("c").join(right.alias("s"), same("c"), "inner").select(*columns, "s.bay_segment")
    seen = catch.select(*SITE_KEYS).distinct()
    unmatched = right.alias("s").join(seen.alias("k"), same("k"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
