"""Explicit schemas of the input tables; codes are text, so that leading zeros and long codes survive."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, WHOLE, REAL, MOMENT = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

PHYSICAL = _table(
    Reference=TEXT,
    Sampling_Date=MOMENT,
    Project_1=TEXT,
    Project_2=TEXT,
    Project_3=TEXT,
    Gear=TEXT,
    Longitude=REAL,
    Latitude=REAL,
    Zone=TEXT,
    Grid=WHOLE,
    Stratum=TEXT,
)

NUMBERS = _table(
    Reference=TEXT,
    Species_record_id=WHOLE,
    Splittype=TEXT,
    Splitlevel=TEXT,
    Cells=WHOLE,
    NODCCODE=TEXT,
    Number=WHOLE,
    FHC=TEXT,
)

SPECIES_LIST = _table(NODCCODE=TEXT, Scientificname=TEXT, Commonname=TEXT)

SPECIES_CLASS = _table(
    TSN=WHOLE,
    NODCCODE=TEXT,
    ScientificName=TEXT,
    Include_Index=TEXT,
    Hab_Cat=TEXT,
    Est_Cat=TEXT,
    Est_Use=TEXT,
    Feeding_Cat=TEXT,
    Feeding_Guild=TEXT,
    Selected_Taxa=TEXT,
)

CATCH = _table(
    Reference=TEXT,
    Project_1=TEXT,
    Project_2=TEXT,
    Project_3=TEXT,
    Sampling_Date=MOMENT,
    Latitude=REAL,
    Longitude=REAL,
    Zone=TEXT,
    Grid=WHOLE,
    Stratum=TEXT,
    effort=REAL,
    Species_record_id=WHOLE,
    NODCCODE=TEXT,
    Scientificname=TEXT,
    Commonname=TEXT,
    Splittype=TEXT,
    Splitlevel=TEXT,
    Cells=WHOLE,
    Number=WHOLE,
)

CATCH_WITH_SEGMENTS = T.StructType([*CATCH.fields, T.StructField("bay_segment", TEXT)])

VERTICES = _table(segment_code=WHOLE, ring_no=WHOLE, vertex_no=WHOLE, x=REAL, y=REAL)

WKT_LAYER = _table(segment_code=WHOLE, wkt=TEXT)

SCORES = _table(
    Reference=TEXT,
    Year=WHOLE,
    Month=WHOLE,
    Season=TEXT,
    bay_segment=TEXT,
    Longitude=REAL,
    Latitude=REAL,
    ScoreNumTaxa=REAL,
    ScoreShannon=REAL,
    ScoreTaxaSelect=REAL,
    ScoreTaxaBenthic=REAL,
    ScoreNumGuilds=REAL,
    Index_Score=REAL,
)

FIELD_METADATA = T.StructType(
    [
        T.StructField(name, TEXT)
        for name in (
            "Data.Field_name",
            "Data_type",
            "Field_length",
            "Units.of.Measure",
            "Precision",
            "Description",
            "Date_added",
            "Date_discontinued",
        )
    ]
)
