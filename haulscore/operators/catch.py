"""From the monitoring tables to the catch table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BAY_PREFIX, EFFORT_M2, FIRST_DATE, GEARS, PROJECT
from ..functions.expressions import normalize_code
from ..runtime import lookup_join
from ..schemas import CATCH


def select_samples(
    physical: DataFrame,
    prefix: str = BAY_PREFIX,
    project: str = PROJECT,
    gears: Sequence[str] = GEARS,
    since: str = FIRST_DATE,
    effort_m2: float = EFFORT_M2,
) -> DataFrame:
    """Hauls of one bay, one project and the given gears since a date, with the effort in 100 m2.

    Each condition is a plain comparison on a stored column, so all of them reach the scan.
    """
    in_project = (F.col("Project_1") == project) | (F.col("Project_2") == project) | (F.col("Project_3") == project)
    return (
        physical.filter(
            F.col("Reference").startswith(prefix)
            & in_project
            & F.col("Gear").isin(*gears)
            & (F.col("Sampling_Date") >= F.lit(datetime.date.fromisoformat(since)))
        )
        .select(
            "Reference",
            "Sampling_Date",
            "Project_1",
            "Project_2",
            "Project_3",
            "Gear",
            "Longitude",
            "Latitude",
            "Zone",
            "Grid",
            "Stratum",
        )
        .withColumn("effort", F.lit(effort_m2 / 100))
    )


def kept_records(numbers: DataFrame) -> DataFrame:
    """Catch records without the deleted ones; a record with no flag at all is dropped too."""
    return numbers.filter(F.col("FHC") != "D").drop("FHC")


def with_repaired_codes(frame: DataFrame) -> DataFrame:
    """Species codes repaired, so that damaged and whole ones meet."""
    return frame.withColumn("NODCCODE", normalize_code(F.col("NODCCODE")))


def build_catch(samples: DataFrame, numbers: DataFrame, species_list: DataFrame) -> DataFrame:
    """One row per catch record of the selected hauls, with haul attributes and species names.

    Both inputs of the haul join grow with the survey, so it is a shuffle join; adaptive execution splits
    the records of a hot haul.
    """
    names = with_repaired_codes(species_list.select("NODCCODE", "Scientificname", "Commonname"))
    records = with_repaired_codes(kept_records(numbers)).join(samples, "Reference", "inner")
    return lookup_join(records, names, ["NODCCODE"], "inner").select(*CATCH.fieldNames())


def distinct_sites(catch: DataFrame) -> DataFrame:
    """One row per haul site; repeats are dropped before the shuffle, however many records a haul has."""
    return catch.select("Reference", "Longitude", "Latitude", "Zone", "Grid").distinct()
