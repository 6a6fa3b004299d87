"""From the survey's tables to the index, ordered so that little is shuffled.

The catch table that the operators build step by step repeats a haul's attributes in every record. Here the
records stay narrow: they are summed per haul and species (combined before the shuffle), turned into one row
of metrics per haul, and only then meet the hauls, whose segment was found in a narrow pass of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.expressions import season
from ..functions.geometry import MOST_EDGES
from ..operators.bands import band_percentiles, with_bands
from ..operators.catch import kept_records, select_samples, with_repaired_codes
from ..operators.counts import combine_counts, with_classes
from ..operators.metrics import METRICS, sample_metrics
from ..operators.reference import reference_conditions
from ..operators.rollup import segment_scores, yearly_scores
from ..operators.scoring import index_scores, metric_scores
from ..operators.segments import assign_segments, override_segments
from ..runtime import lookup_join, settle


@dataclass(frozen=True)
class SurveyTables:
    """The five inputs: hauls, catch records, species names, species classes, segment polygons."""

    physical: DataFrame
    numbers: DataFrame
    species_list: DataFrame
    species: DataFrame
    segments: DataFrame


@dataclass(frozen=True)
class IndexSettings:
    prefix: str = C.BAY_PREFIX
    project: str = C.PROJECT
    gears: Sequence[str] = C.GEARS
    since: str = C.FIRST_DATE
    cell_edges: int = MOST_EDGES
    grid_segments: Mapping[int, str] = field(default_factory=lambda: dict(C.GRID_SEGMENTS))
    rule_axis: str = "x"
    rule_below: float = C.CONDITIONAL_BELOW
    sentinel: str = C.SENTINEL_SPECIES
    reference_years: tuple[int, int] = C.REFERENCE_YEARS
    reference_probs: Sequence[float] = C.REFERENCE_PROBS
    band_probs: Sequence[float] = C.BAND_PROBS
    clamp_all: bool = False


@dataclass(frozen=True)
class IndexTables:
    """The results. ``metrics``, ``conditions`` and ``scores`` are written tables; the others are plans over them."""

    metrics: DataFrame
    conditions: DataFrame
    scores: DataFrame
    yearly: DataFrame
    segment_yearly: DataFrame
    bands: DataFrame
    banded_years: DataFrame


def survey_hauls(tables: SurveyTables, settings: IndexSettings) -> DataFrame:
    """Selected hauls inside the main segments: filters, a broadcast look-up and projections; no shuffle."""
    samples = select_samples(
        tables.physical, settings.prefix, settings.project, settings.gears, settings.since
    )
    placed = assign_segments(samples, tables.segments, settings.cell_edges)
    kept = override_segments(
        placed, settings.grid_segments, axis=settings.rule_axis, below=settings.rule_below
    )
    return kept.select(
        "Reference",
        F.year("Sampling_Date").alias("Year"),
        F.month("Sampling_Date").alias("Month"),
        season(F.month("Sampling_Date")).alias("Season"),
        "bay_segment",
        "Longitude",
        "Latitude",
    )


def survey_counts(tables: SurveyTables, settings: IndexSettings) -> DataFrame:
    """Totals per haul and index species, named and classed; the look-ups come after the records are summed."""
    records = kept_records(tables.numbers).filter(F.col("Reference").startswith(settings.prefix))
    counts = combine_counts(records)
    names = with_repaired_codes(tables.species_list.select("NODCCODE", "Scientificname"))
    return with_classes(lookup_join(counts, names, ["NODCCODE"], "inner"), tables.species)


def haul_metrics(tables: SurveyTables, settings: IndexSettings) -> DataFrame:
    """One row of metrics per selected haul; the join is one to one and on the key the metrics already sit by."""
    hauls = survey_hauls(tables, settings)
    metrics = sample_metrics(survey_counts(tables, settings), settings.sentinel)
    return metrics.join(hauls, "Reference", "inner").select(*hauls.columns, *METRICS)


def score_hauls(metrics: DataFrame, settings: IndexSettings) -> tuple[DataFrame, DataFrame]:
    """(reference conditions, scores) of a stored or settled metric table."""
    conditions = settle(
        reference_conditions(metrics, settings.reference_years, settings.reference_probs), "conditions"
    )
    scores = index_scores(
        metric_scores(metrics, conditions, settings.reference_probs, clamp_all=settings.clamp_all)
    )
    return conditions, scores


def run_index(tables: SurveyTables, settings: IndexSettings | None = None) -> IndexTables:
    """All results. Metrics and scores are written once each, since several results read them."""
    settings = settings or IndexSettings()
    metrics = settle(haul_metrics(tables, settings), "metrics")
    conditions, scores = score_hauls(metrics, settings)
    scores = settle(scores, "scores")
    yearly = yearly_scores(scores)
    bands = band_percentiles(scores, settings.reference_years, settings.band_probs)
    return IndexTables(
        metrics=metrics,
        conditions=conditions,
        scores=scores,
        yearly=yearly,
        segment_yearly=segment_scores(scores),
        bands=bands,
        banded_years=with_bands(yearly, bands, settings.band_probs),
    )
