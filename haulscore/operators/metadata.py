"""Descriptions of the catch table's fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FIELD_METADATA

# The fields of the catch table that the survey's own metadata describes.
DESCRIBED_FIELDS = (
    "Reference",
    "Project_1",
    "Project_2",
    "Project_3",
    "Sampling_Date",
    "Latitude",
    "Longitude",
    "Zone",
    "Grid",
    "Stratum",
    "effort",
    "Species_record_id",
    "NODCCODE",
    "Scientificname",
    "Splittype",
    "Splitlevel",
    "Cells",
)

# Fields that it does not describe.
ADDED_FIELDS = (
    {
        "Data.Field_name": "Commonname",
        "Data_type": "Character",
        "Description": "Common name for each species",
    },
    {
        "Data.Field_name": "effort",
        "Data_type": "Decimal",
        "Units.of.Measure": "per 100 m2",
        "Description": "effort expressed per 100 m2",
    },
    {
        "Data.Field_name": "Number",
        "Data_type": "Integer",
        "Units.of.Measure": "individuals",
        "Description": "Number of individuals collected",
    },
)


def field_metadata(
    metadata: DataFrame,
    fields: Sequence[str] = DESCRIBED_FIELDS,
    added: Sequence[Mapping[str, str]] = ADDED_FIELDS,
) -> DataFrame:
    """Distinct descriptions of the wanted fields, and rows for fields that have none; other columns are NULL."""
    columns = [f"`{name}`" for name in FIELD_METADATA.fieldNames()]
    known = metadata.select(*columns).filter(F.col("`Data.Field_name`").isin(*fields)).distinct()
    if not added:
        return known
    names = list(dict.fromkeys(name for row in added for name in row))
    schema = ", ".join(f"`{name}` string" for name in names)
    extra = metadata.sparkSession.createDataFrame([tuple(row.get(n) for n in names) for row in added], schema)
    return known.unionByName(extra, allowMissingColumns=True)
