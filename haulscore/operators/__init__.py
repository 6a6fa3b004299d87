from .bands import band_percentiles, colour_class, with_bands
from .catch import build_catch, distinct_sites, select_samples
from .compare import compare_tables
from .counts import combine_counts, expand_counts, prepare_counts, with_classes
from .mapping import padded_extent, within_extent, year_map_samples, year_map_segments
from .metadata import field_metadata
from .metrics import METRICS, assemble, sample_metrics
from .quality import quality_report
from .reference import reference_conditions
from .rollup import segment_scores, yearly_scores
from .scoring import index_scores, metric_scores
from .segments import assign_segments, attach_segments, override_segments

__all__ = [
    "METRICS",
    "assemble",
    "assign_segments",
    "attach_segments",
    "band_percentiles",
    "build_catch",
    "colour_class",
    "combine_counts",
    "compare_tables",
    "distinct_sites",
    "expand_counts",
    "field_metadata",
    "index_scores",
    "metric_scores",
    "override_segments",
    "padded_extent",
    "prepare_counts",
    "quality_report",
    "reference_conditions",
    "sample_metrics",
    "segment_scores",
    "select_samples",
    "with_bands",
    "with_classes",
    "within_extent",
    "year_map_samples",
    "year_map_segments",
    "yearly_scores",
]
