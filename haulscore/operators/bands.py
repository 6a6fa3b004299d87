"""Colour bands of the index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BAND_PROBS, GREEN, GREEN_MIN, RED, RED_MAX, REFERENCE_YEARS, YELLOW
from ..functions.quantiles import exact_quantiles, prob_label


def band_percentiles(
    scores: DataFrame, years: tuple[int, int] = REFERENCE_YEARS, probs: Sequence[float] = BAND_PROBS
) -> DataFrame:
    """One row: exact percentiles of the index over all hauls of the reference years.

    ``scores`` is read more than once: give it a stored or settled table.
    """
    in_years = scores.filter(F.col("Year").between(*years)).select(F.col("Index_Score").alias("Score"))
    return exact_quantiles(in_years, [], ["Score"], probs)


def with_bands(yearly: DataFrame, bands: DataFrame, probs: Sequence[float] = BAND_PROBS) -> DataFrame:
    """Add the upper limits of the red, yellow and green bands; the one-row table enters as scalar subqueries."""
    red, yellow = (f"Score_{prob_label(p)}" for p in probs)
    return yearly.withColumns(
        {
            "Red": bands.select(red).scalar(),
            "Yellow": bands.select(yellow).scalar(),
            "Green": F.lit(100.0),
        }
    )


def colour_class(score: Column, red_max: float = RED_MAX, green_min: float = GREEN_MIN) -> Column:
    """Red up to one score, green from another; yellow between them, and also where the score is missing."""
    return F.when(score <= red_max, RED).when(score >= green_min, GREEN).otherwise(YELLOW)
