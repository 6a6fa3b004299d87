"""Metadata, comparison and quality checks."""

from pyspark.sql import functions as F

from haulscore import schemas
from haulscore.operators import compare_tables, field_metadata, quality_report
from helpers import NO_FISH, NO_GEAR, rows, species


def test_field_metadata(spark):
    data = [
        ("Grid", "SmallInt", None, None, "0", "Grid number", None, None),
        ("Grid", "SmallInt", None, None, "0", "Grid number", None, None),
        ("Secchi", "Decimal", None, "m", "1", "Depth", None, None),
    ]
    got = field_metadata(spark.createDataFrame(data, schemas.FIELD_METADATA))
    assert got.columns == schemas.FIELD_METADATA.fieldNames()
    names = [r[0] for r in rows(got, "`Data.Field_name`")]
    assert names == ["Commonname", "Grid", "Number", "effort"]
    effort = got.filter("`Data.Field_name` = 'effort'").first()
    assert effort["Units.of.Measure"] == "per 100 m2" and effort["Precision"] is None
    assert field_metadata(spark.createDataFrame(data, schemas.FIELD_METADATA), ["Secchi"], []).count() == 1


def test_comparison(spark):
    a = spark.createDataFrame([("x", 1.0, "p", 1), ("y", 1.0, "p", None), ("z", 1.0, "p", 1)], "Reference string, v double, s string, n int")
    b = spark.createDataFrame([("x", 1.05, "p", 1), ("y", 1.2, "q", 1), ("w", 1.0, "p", 1)], "Reference string, v double, s string, n int")
    got = compare_tables(a, b)
    assert rows(got, "Reference", "status", "column") == [
        ("w", "only_b", None),
        ("y", "differs", "n"),
        ("y", "differs", "s"),
        ("y", "differs", "v"),
        ("z", "only_a", None),
    ]
    assert rows(compare_tables(a, b, tol=0.3, columns=["v"]).filter("status = 'differs'")) == []


def test_comparison_of_missing_keys_mixed_types_and_lone_columns(spark):
    a = spark.createDataFrame([(None, 1.0, "p", 1), ("x", 1.0, "7", 2)], "Reference string, v double, s string, mine int")
    b = spark.createDataFrame([("x", "1.05", 7.0), ("y", "no number", None)], "Reference string, v string, s double")
    got = rows(compare_tables(a, b), "Reference", "status", "column")
    assert got == sorted(
        [(None, "only_a", None), ("y", "only_b", None), (None, "column_only_a", "mine")], key=lambda r: tuple((v is not None, str(v)) for v in r)
    )
    c = spark.createDataFrame([(None, "2.0", "q"), ("x", "no number", "7")], "Reference string, v string, s string")
    got = compare_tables(a, c, columns=["v", "s"])
    assert rows(got, "Reference", "column") == [(None, "s"), (None, "v"), ("x", "v")]
    assert rows(compare_tables(b, a, columns=["s"]).filter("status <> 'differs'"), "Reference", "status") == [(None, "only_b"), ("y", "only_a")]


def test_quality_report(spark):
    catch = spark.createDataFrame(
        [
            ("a", "100", 1, None, None, "2000-01-01", 1.0),
            ("a", NO_FISH, 0, None, None, "2000-01-01", 1.0),
            ("b", "100", 0, None, None, "2000-01-01", 1.0),
            ("b", "200", None, "2", None, "2000-01-01", 2.0),
            ("c", "777", 1, None, None, None, 1.0),
            (None, NO_GEAR, 0, None, None, "2000-01-01", 1.0),
        ],
        "Reference string, NODCCODE string, Number int, Splittype string, Splitlevel string, Sampling_Date string, Longitude double",
    ).withColumn("Sampling_Date", F.col("Sampling_Date").cast("date"))
    repeated = [(8, "100", "Alpha again", "Y", "B", "MS", "O", "TS", "ZB", "Y")]
    got = rows(quality_report(catch, species(spark, repeated)))
    assert got == sorted(
        [
            ("duplicate_class", "100", 2),
            ("mixed_no_fish", "Reference", 1),
            ("null_value", "Number", 1),
            ("null_value", "Reference", 1),
            ("null_value", "Sampling_Date", 1),
            ("split_without_level", "Splitlevel", 1),
            ("unclassified_species", "777", 1),
            ("unknown_code", "Feeding_Cat", 1),
            ("unknown_code", "Feeding_Guild", 2),
            ("varying_attributes", "Reference", 1),
            ("zero_count", "Number", 1),
        ]
    )
