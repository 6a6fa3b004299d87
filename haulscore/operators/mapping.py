"""The tables behind a one-year map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GREEN_MIN, MAIN_SEGMENTS, RED_MAX
from ..runtime import lookup_join, settle
from .bands import colour_class
from .rollup import segment_scores


def _segment_means(scores: DataFrame, year: int) -> DataFrame:
    """Segment means of one year: one row per segment."""
    return settle(segment_scores(scores.filter(F.col("Year") == year), "SegScore"), "segment-means")


def year_map_samples(
    scores: DataFrame, year: int, red_max: float = RED_MAX, green_min: float = GREEN_MIN
) -> DataFrame:
    """The hauls of a year with their segment's mean, each coloured by its own score."""
    hauls = scores.filter(F.col("Year") == year).select(
        "Reference", "Year", "bay_segment", "Longitude", "Latitude", "Index_Score"
    )
    joined = lookup_join(hauls, _segment_means(scores, year), ["Year", "bay_segment"], "left", null_safe=True)
    return joined.withColumn("MapCol", colour_class(F.col("Index_Score"), red_max, green_min))


def year_map_segments(
    scores: DataFrame,
    segments: DataFrame,
    year: int,
    main: Sequence[str] = MAIN_SEGMENTS,
    red_max: float = RED_MAX,
    green_min: float = GREEN_MIN,
) -> DataFrame:
    """The main segments with their mean and colour of a year; NULL for a segment without hauls."""
    means = _segment_means(scores, year).withColumn("MapCol", colour_class(F.col("SegScore"), red_max, green_min))
    layer = segments.filter(F.col("bay_segment").isin(*main))
    return lookup_join(layer, means, ["bay_segment"], "left")


def padded_extent(points: DataFrame, pad_x: float = 0.25, pad_y: float = 0.10) -> DataFrame:
    """One row: the bounding box of the points, widened by a share of its width and height on every side."""
    box = points.agg(
        F.min("Longitude").alias("xmin"),
        F.max("Longitude").alias("xmax"),
        F.min("Latitude").alias("ymin"),
        F.max("Latitude").alias("ymax"),
    )
    dx, dy = (F.col("xmax") - F.col("xmin")) * pad_x, (F.col("ymax") - F.col("ymin")) * pad_y
    return box.select(
        (F.col("xmin") - dx).alias("xmin"),
        (F.col("ymin") - dy).alias("ymin"),
        (F.col("xmax") + dx).alias("xmax"),
        (F.col("ymax") + dy).alias("ymax"),
    )


def within_extent(points: DataFrame, extent: DataFrame) -> DataFrame:
    """Points inside a one-row extent, which enters as one scalar subquery."""

    box = extent.select(F.struct("xmin", "xmax", "ymin", "ymax").alias("box")).scalar()
    return (
        points.withColumn("_box", box)
        .filter(
            F.col("Longitude").between(F.col("_box.xmin"), F.col("_box.xmax"))
            & F.col("Latitude").between(F.col("_box.ymin"), F.col("_box.ymax"))
        )
        .drop("_box")
    )
