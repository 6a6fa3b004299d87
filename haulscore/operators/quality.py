"""Checks of what the aggregates would pass over in silence."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CLASS_CODES, NO_FISH, NO_GEAR_SET
from ..functions.expressions import as_number, normalize_code
from ..runtime import write_observed

ATTRIBUTES = ("Sampling_Date", "Longitude", "Latitude", "Zone", "Grid", "bay_segment")


def record_checks(code: Column) -> dict[tuple[str, str], Column]:
    """The checks that look at one record alone; ``code`` is its repaired species code."""
    split = as_number(F.col("Splittype")).isNotNull() & as_number(F.col("Splitlevel")).isNull()
    return {
        ("null_value", "Reference"): F.col("Reference").isNull(),
        ("null_value", "NODCCODE"): code.isNull(),
        ("null_value", "Number"): F.col("Number").isNull(),
        ("null_value", "Sampling_Date"): F.col("Sampling_Date").isNull(),
        ("split_without_level", "Splitlevel"): split,
        ("zero_count", "Number"): (F.col("Number") == 0) & ~code.isin(NO_FISH, NO_GEAR_SET),
    }


def write_checked(catch: DataFrame, write: Callable[[DataFrame], None]) -> DataFrame:
    """Write the catch table and give the report of the record checks, counted by the tasks that write: the table is computed once.

    ``write`` runs one action on the frame it is given. The rows are those that ``quality_report`` has for these checks.
    """
    tests = record_checks(normalize_code(F.col("NODCCODE")))
    counts = write_observed(catch, write, **{f"t{i}": F.count(F.when(test, 1)) for i, test in enumerate(tests.values())})
    found = [(check, item, counts[f"t{i}"]) for i, (check, item) in enumerate(tests) if counts[f"t{i}"]]
    return catch.sparkSession.createDataFrame(found, "check string, item string, n long")


def quality_report(catch: DataFrame, species: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """(check, item, n): how many rows, keys or hauls fail each check; a check that finds nothing has no row.

    All checks are sums and distinct counts that combine before the shuffle. ``item`` says which column or code.
    """
    records = catch.withColumn("NODCCODE", normalize_code(F.col("NODCCODE")))
    classes = species.withColumn("NODCCODE", normalize_code(F.col("NODCCODE")))

    def rows(frame: DataFrame, tests: dict[tuple[str, str], Column]) -> DataFrame:
        sums = [F.count(F.when(test, 1)).alias(f"t{i}") for i, test in enumerate(tests.values())]
        found = [
            F.struct(F.lit(check).alias("check"), F.lit(item).alias("item"), F.col(f"t{i}").alias("n"))
            for i, (check, item) in enumerate(tests)
        ]
        return frame.agg(*sums).select(F.explode(F.array(*found)).alias("r")).select("r.*")

    per_record = rows(records, record_checks(F.col("NODCCODE")))
    odd_codes = rows(
        classes.filter(F.col("Include_Index") == "Y").filter(F.col("NODCCODE") != NO_FISH),
        {
            ("unknown_code", column): F.coalesce(~F.col(column).isin(*codes), F.lit(True))
            for column, codes in CLASS_CODES.items()
        },
    )
    duplicates = (
        classes.groupBy("NODCCODE")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select(F.lit("duplicate_class").alias("check"), F.col("NODCCODE").alias("item"), F.col("copies").alias("n"))
    )
    unclassified = (
        records.filter(F.col("NODCCODE").isNotNull())
        .groupBy("NODCCODE")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(classes.select("NODCCODE").distinct(), "NODCCODE", "left_anti")
        .select(F.lit("unclassified_species").alias("check"), F.col("NODCCODE").alias("item"), "n")
    )
    empty = F.col("NODCCODE") == NO_FISH
    hauls = records.groupBy("Reference").agg(
        F.max(F.when(empty, 1).otherwise(0)).alias("has_empty"),
        F.max(F.when(empty, 0).otherwise(1)).alias("has_catch"),
    )
    mixed = rows(hauls, {("mixed_no_fish", "Reference"): (F.col("has_empty") == 1) & (F.col("has_catch") == 1)})
    present = [c for c in attributes if c in records.columns]
    # One narrow list of variants per haul: duplicates go before the shuffle, then variants are counted.
    varying = rows(
        records.select("Reference", *present).distinct().groupBy("Reference").agg(F.count(F.lit(1)).alias("variants")),
        {("varying_attributes", "Reference"): F.col("variants") > 1},
    )
    checks = [per_record, odd_codes, duplicates, unclassified, mixed, varying]
    return reduce(DataFrame.unionByName, checks).filter("n > 0")
