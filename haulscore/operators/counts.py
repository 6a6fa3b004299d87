"""Counts per haul and species."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..constants import NO_GEAR_SET
from ..functions.expressions import bay_code, calendar_date, expanded_count, normalize_code, null_keeping_sum
from ..runtime import lookup_join

CLASS_COLUMNS = (
    "TSN",
    "Include_Index",
    "Hab_Cat",
    "Est_Cat",
    "Est_Use",
    "Feeding_Cat",
    "Feeding_Guild",
    "Selected_Taxa",
)
RECORD_COLUMNS = ("Splittype", "Splitlevel", "Species_record_id", "Cells", "Number")


def expand_counts(records: DataFrame) -> DataFrame:
    """Repair the species code and scale subsample counts up; "no gear set" records are dropped."""
    return records.withColumns(
        {
            "NODCCODE": normalize_code(F.col("NODCCODE")),
            "Count": expanded_count(F.col("Number"), F.col("Splittype"), F.col("Splitlevel")),
        }
    ).filter(F.col("NODCCODE") != NO_GEAR_SET)


def combine_counts(records: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per haul and species with its total. ``carry`` names columns that depend on the two keys.

    The sum is combined before the shuffle, and the shuffle is by haul and species: a haul that holds a
    large share of all records leaves each task as at most one row per species.
    """
    return (
        expand_counts(records)
        .groupBy("Reference", "NODCCODE", *carry)
        .agg(null_keeping_sum(F.col("Count")).alias("Total_N"))
    )


def with_classes(counts: DataFrame, species: DataFrame) -> DataFrame:
    """Add the class codes and keep the species of the index. The class table's own name column stays out."""
    classes = (
        species.withColumn("NODCCODE", normalize_code(F.col("NODCCODE")))
        .filter(F.col("Include_Index") == "Y")
        .select("NODCCODE", *CLASS_COLUMNS)
    )
    return lookup_join(counts, classes, ["NODCCODE"], "inner")


def prepare_counts(catch: DataFrame, species: DataFrame) -> DataFrame:
    """Catch records to one row per haul and index species, with haul attributes and class codes.

    A sampling date that is text may be spelled in any way that ``calendar_date`` knows.
    """
    is_text = isinstance(catch.schema["Sampling_Date"].dataType, StringType)
    date = calendar_date(F.col("Sampling_Date")) if is_text else F.to_date("Sampling_Date")
    attributes = [c for c in catch.columns if c not in ("Reference", "NODCCODE", *RECORD_COLUMNS)]
    counts = combine_counts(catch, attributes).withColumns(
        {
            "Sampling_Date": date,
            "Bay": bay_code(F.col("Reference")),
            "Year": F.year(date),
            "Month": F.month(date),
        }
    )
    return with_classes(counts, species)
