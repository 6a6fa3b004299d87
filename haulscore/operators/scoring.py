"""Scores of the index metrics, and the index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INDEX_METRICS, REFERENCE_PROBS
from ..functions.expressions import ratio, round_half_even
from ..functions.quantiles import prob_label
from ..runtime import lookup_join

CLAMPED = ("BenthicTaxa",)
SAMPLE_COLUMNS = ("Reference", "Year", "Month", "Season", "bay_segment", "Longitude", "Latitude")


def _score(name: str, low: Column, high: Column, clamp: bool) -> Column:
    value = F.col(name)
    scaled = ratio(value - low, high - low) * 10
    score = F.when(F.col("NumTaxa") == 0, 0.0).when(value > high, 10.0)
    if clamp:
        # Covers an empty reference range too, where the quotient has no value.
        score = score.when(value < low, 0.0)
    return round_half_even(score.otherwise(scaled))


def metric_scores(
    metrics: DataFrame,
    conditions: DataFrame,
    probs: Sequence[float] = REFERENCE_PROBS,
    by: Sequence[str] = ("bay_segment", "Season"),
    clamp_all: bool = False,
) -> DataFrame:
    """Score each index metric between its low (0) and high (10) reference value.

    Hauls without taxa score 0, values above the high one 10. Only the benthic score is held at 0 from below
    unless ``clamp_all``: the others go negative. A haul whose reference condition is missing has NULL scores.
    ``conditions`` is measured before it is broadcast: give it a stored or settled table.
    """
    low, high = (prob_label(p) for p in probs)
    joined = lookup_join(metrics.select(*SAMPLE_COLUMNS, *INDEX_METRICS), conditions, by, "left", null_safe=True)
    return joined.select(
        *SAMPLE_COLUMNS,
        *[
            _score(name, F.col(f"{name}_{low}"), F.col(f"{name}_{high}"), clamp_all or name in CLAMPED).alias(score)
            for name, score in INDEX_METRICS.items()
        ],
    )


def index_scores(scores: DataFrame) -> DataFrame:
    """The mean of the metric scores on a scale of 0 to 100; NULL if one of them is."""
    names = list(INDEX_METRICS.values())
    total = sum((F.col(name) for name in names[1:]), F.col(names[0]))
    return scores.withColumn("Index_Score", total / len(names) * 10)
