import pytest
from pyspark.sql import functions as F

from haulscore import schemas
from haulscore.operators import (
    band_percentiles,
    colour_class,
    padded_extent,
    segment_scores,
    with_bands,
    within_extent,
    year_map_samples,
    year_map_segments,
    yearly_scores,
)
from helpers import layer, rows, square


def scored(spark, hauls):
    """Hauls (year, segment, score[, lon, lat])."""
    data = []
    for i, (year, segment, value, *place) in enumerate(hauls):
        lon, lat = place or (0.0, 0.0)
        data.append((f"r{i}", year, 1, "Winter", segment, lon, lat, 0.0, 0.0, 0.0, 0.0, 0.0, value))
    return spark.createDataFrame(data, schemas.SCORES)


def test_yearly_mean_error_and_bounds_use_the_rounded_mean(spark):
    got = yearly_scores(scored(spark, [(2000, "HB", 40.0), (2000, "HB", 41.0), (2001, "HB", 40.0)]))
    assert rows(got) == [(2000, 40.0, 0.5, 39.5, 40.5), (2001, 40.0, None, None, None)]


def test_a_missing_score_makes_the_mean_missing(spark):
    frame = scored(spark, [(2000, "HB", 40.0), (2000, "HB", None), (2000, "OTB", 43.0)])
    assert rows(yearly_scores(frame)) == [(2000, None, None, None, None)]
    assert rows(segment_scores(frame)) == [("HB", 2000, None), ("OTB", 2000, 43.0)]


def test_bands(spark):
    frame = scored(spark, [(1997, "HB", 1000.0), *[(2000, "HB", float(v)) for v in range(0, 101, 10)], (2016, "HB", 900.0)])
    bands = band_percentiles(frame)
    assert bands.columns == ["Score_P33", "Score_P50"]
    assert list(bands.first()) == pytest.approx([33.0, 50.0])
    got = with_bands(yearly_scores(frame), bands).orderBy("Year").collect()
    assert len(got) == 3
    assert all((r["Red"], r["Yellow"], r["Green"]) == (pytest.approx(33.0), 50.0, 100.0) for r in got)


def test_colours(spark):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate((32.0, 33.0, 45.0, 46.0, None))], "i int, v double")
    got = [r[0] for r in frame.orderBy("i").select(colour_class(F.col("v"))).collect()]
    assert got == ["#FF0000", "#FFFF00", "#FFFF00", "#008000", "#FFFF00"]


def test_year_map(spark):
    frame = scored(spark, [(2018, "OTB", 20.0), (2018, "OTB", 41.0), (2018, "HB", 50.0), (2018, None, 60.0), (2017, "MTB", 10.0)])
    got = year_map_samples(frame, 2018)
    assert rows(got, "Reference", "bay_segment", "SegScore", "MapCol") == [
        ("r0", "OTB", 30.0, "#FF0000"),
        ("r1", "OTB", 30.0, "#FFFF00"),
        ("r2", "HB", 50.0, "#008000"),
        ("r3", None, 60.0, "#008000"),
    ]
    polygons = layer(spark, square(1, 0, 0, 1, 1), square(2, 1, 0, 2, 1), square(3, 2, 0, 3, 1), square(5, 3, 0, 4, 1))
    regions = year_map_segments(frame, polygons, 2018)
    assert rows(regions, "bay_segment", "Year", "SegScore", "MapCol") == [
        ("HB", 2018, 50.0, "#008000"),
        ("MTB", None, None, None),
        ("OTB", 2018, 30.0, "#FF0000"),
    ]
    assert "rings" in regions.columns


def test_extent(spark):
    frame = scored(spark, [(2018, "OTB", 1.0, 0.0, 10.0), (2018, "OTB", 1.0, 4.0, 30.0)])
    box = padded_extent(frame)
    assert list(box.first()) == [-1.0, 8.0, 5.0, 32.0]
    others = scored(spark, [(1, "a", 1.0, -1.0, 8.0), (1, "b", 1.0, 5.1, 9.0), (1, "c", 1.0, 0.0, 33.0)])
    assert rows(within_extent(others, box), "bay_segment") == [("a",)]
