"""Reference conditions: percentiles of the index metrics per segment and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import INDEX_METRICS, REFERENCE_PROBS, REFERENCE_YEARS, UNROUNDED_METRICS
from ..functions.expressions import round_half_even
from ..functions.quantiles import exact_quantiles, prob_label


def reference_conditions(
    metrics: DataFrame,
    years: tuple[int, int] = REFERENCE_YEARS,
    probs: Sequence[float] = REFERENCE_PROBS,
    by: Sequence[str] = ("bay_segment", "Season"),
) -> DataFrame:
    """Exact percentiles over the reference years; those of counts are rounded to whole numbers.

    ``metrics`` is read more than once: give it a stored or settled table.
    """
    names = list(INDEX_METRICS)
    quantiles = exact_quantiles(metrics.filter(F.col("Year").between(*years)), by, names, probs)
    columns = [(name, f"{name}_{prob_label(p)}") for name in names for p in probs]
    return quantiles.select(
        *by,
        *[F.col(c) if name in UNROUNDED_METRICS else round_half_even(F.col(c)).alias(c) for name, c in columns],
    )
