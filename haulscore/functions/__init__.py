from .expressions import (
    bay_code,
    calendar_date,
    expanded_count,
    normalize_code,
    null_keeping_avg,
    null_keeping_sum,
    ratio,
    round_half_even,
    season,
    segment_name,
    zero_if,
)
from .geometry import Cells, segment_cells
from .quantiles import exact_quantiles

__all__ = [
    "Cells",
    "bay_code",
    "calendar_date",
    "exact_quantiles",
    "expanded_count",
    "normalize_code",
    "null_keeping_avg",
    "null_keeping_sum",
    "ratio",
    "round_half_even",
    "season",
    "segment_cells",
    "segment_name",
    "zero_if",
]
