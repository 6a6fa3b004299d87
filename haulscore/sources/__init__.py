from .colocated import Colocated, open_colocated, write_colocated
from .readers import read_csv, read_jdbc, read_table, segments_from_vertices, segments_from_wkt
from .writers import write_csv, write_scores, write_table

__all__ = [
    "Colocated",
    "open_colocated",
    "read_csv",
    "read_jdbc",
    "read_table",
    "segments_from_vertices",
    "segments_from_wkt",
    "write_colocated",
    "write_csv",
    "write_scores",
    "write_table",
]
