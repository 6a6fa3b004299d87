"""Small survey tables for the tests. Species and hauls are invented."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from haulscore import schemas

NO_FISH, NO_GEAR = "9998000000", "9999000000"


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan_of(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def initial_plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString()


SPECIES = [
    # TSN, code, name, include, hab, est cat, use, feeding, guild, selected
    (1, "100", "Alpha", "Y", "B", "MS", "O", "TS", "ZB", "Y"),
    (2, "200", "Beta", "Y", "P", "ES", "S", "TG", "PV", "N"),
    (3, "300", "Gamma", "Y", "B", "FS", "F", "TS", "", "N"),
    (4, "400", "Delta", "N", "B", "MS", "O", "TS", "ZB", "Y"),
    (5, "500", "Epsilon", "Y", "B", "ES", "O", "ZP", "TS", "Y"),
    (6, NO_FISH, "No fish", "Y", ".", ".", ".", ".", ".", "N"),
    (7, NO_GEAR, "No gear set", "N", ".", ".", ".", ".", ".", "N"),
]


def species(spark: SparkSession, extra=()) -> DataFrame:
    return spark.createDataFrame([*SPECIES, *extra], schemas.SPECIES_CLASS)


def species_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(code, name, f"common {name}") for _, code, name, *_ in SPECIES], schemas.SPECIES_LIST)


def numbers(spark: SparkSession, records) -> DataFrame:
    """Records (reference, code, number[, splittype, splitlevel, fhc])."""
    full = []
    for i, record in enumerate(records):
        reference, code, number, *rest = record
        split, level, fhc = (*rest, *(None, None, "F")[len(rest) :])
        full.append((reference, i, split, level, 1, code, number, fhc))
    return spark.createDataFrame(full, schemas.NUMBERS)


def physical(spark: SparkSession, references, **changes) -> DataFrame:
    base = dict(
        Sampling_Date=datetime.datetime(2000, 5, 1, 10, 30),
        Project_1="AM",
        Project_2=None,
        Project_3=None,
        Gear="20",
        Longitude=0.5,
        Latitude=0.5,
        Zone="A",
        Grid=1,
        Stratum="S",
    )
    base.update(changes)
    full = []
    for reference in references:
        own = {}
        if isinstance(reference, tuple):
            reference, own = reference
        full.append((reference, *[(base | own)[f.name] for f in schemas.PHYSICAL.fields[1:]]))
    return spark.createDataFrame(full, schemas.PHYSICAL)


def square(code, x0, y0, x1, y1, ring_no=1):
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return [(code, ring_no, i, float(x), float(y)) for i, (x, y) in enumerate(corners)]


def layer(spark: SparkSession, *polygons) -> DataFrame:
    from haulscore.sources import segments_from_vertices

    return segments_from_vertices(spark.createDataFrame([v for p in polygons for v in p], schemas.VERTICES))


def counts(spark: SparkSession, records) -> DataFrame:
    """Classed counts (reference, code, total)."""
    from haulscore.operators import with_classes

    names = {code: name for _, code, name, *_ in SPECIES}
    frame = spark.createDataFrame(
        [(r, c, None if n is None else float(n), names[c]) for r, c, n in records],
        "Reference string, NODCCODE string, Total_N double, Scientificname string",
    )
    return with_classes(frame, species(spark))
