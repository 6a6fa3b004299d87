"""Yearly and segment means of the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import null_keeping_avg, round_half_even


def yearly_scores(scores: DataFrame) -> DataFrame:
    """Rounded mean per year, standard error, and bounds around the rounded mean.

    A missing score makes its year's mean and error NULL. A year with one haul has no error.
    """
    score = F.col("Index_Score")
    known = F.count(score) == F.count(F.lit(1))
    means = scores.groupBy("Year").agg(
        round_half_even(null_keeping_avg(score)).alias("Yr_Index"),
        F.when(known, F.stddev_samp(score) / F.sqrt(F.count(F.lit(1)))).alias("SEM"),
    )
    return means.withColumns(
        {"lower_sem": F.col("Yr_Index") - F.col("SEM"), "upper_sem": F.col("Yr_Index") + F.col("SEM")}
    )


def segment_scores(scores: DataFrame, name: str = "Segment_Index") -> DataFrame:
    """Rounded mean per segment and year."""
    return scores.groupBy("bay_segment", "Year").agg(
        round_half_even(null_keeping_avg(F.col("Index_Score"))).alias(name)
    )
