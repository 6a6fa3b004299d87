import datetime

from pyspark.sql import functions as F

from haulscore import schemas
from haulscore.operators import build_catch, combine_counts, distinct_sites, prepare_counts, select_samples
from haulscore.sources import read_table
from helpers import NO_FISH, NO_GEAR, numbers, physical, plan_of, rows, species, species_list


def test_sample_selection(spark):
    hauls = physical(
        spark,
        [
            "TBM01",
            ("CKM02", {}),
            ("TBM03", {"Project_1": None, "Project_2": "AM"}),
            ("TBM04", {"Project_1": "XX", "Project_3": "AM", "Gear": "19"}),
            ("TBM05", {"Project_1": "XX"}),
            ("TBM06", {"Project_1": None}),
            ("TBM07", {"Gear": "23"}),
            ("TBM08", {"Gear": None}),
            ("TBM09", {"Sampling_Date": datetime.datetime(1997, 12, 31, 23, 59)}),
            ("TBM10", {"Sampling_Date": datetime.datetime(1998, 1, 1)}),
            ("TBM11", {"Sampling_Date": None}),
        ],
    )
    got = select_samples(hauls)
    assert [r[0] for r in rows(got, "Reference")] == ["TBM01", "TBM03", "TBM04", "TBM10"]
    assert rows(got.select("effort").distinct()) == [(1.4,)]
    assert [r[0] for r in rows(select_samples(hauls, prefix="CKM", gears=["20"]), "Reference")] == ["CKM02"]


def test_selection_reaches_the_scan(spark, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "4000")
    path = str(tmp_path / "physical")
    physical(spark, ["TBM01", "CKM02"]).write.parquet(path)
    plan = plan_of(select_samples(read_table(spark, path, schemas.PHYSICAL)))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("StringStartsWith(Reference,TBM)", "In(Gear, [19,20])", "GreaterThanOrEqual(Sampling_Date", "EqualTo(Project_1,AM)"):
        assert part in pushed


def test_catch_table(spark):
    records = numbers(
        spark,
        [
            ("TBM01", "100", 3),
            ("TBM01", "200", 1, None, None, "D"),
            ("TBM01", "300", 1, None, None, None),
            ("TBM01", "999", 5),
            ("TBM02", "100", 2),
        ],
    )
    catch = build_catch(select_samples(physical(spark, ["TBM01"])), records, species_list(spark))
    assert catch.columns == schemas.CATCH.fieldNames()
    assert rows(catch, "Reference", "NODCCODE", "Scientificname", "Commonname", "Number", "effort") == [
        ("TBM01", "100", "Alpha", "common Alpha", 3, 1.4)
    ]


def test_distinct_sites(spark):
    records = numbers(spark, [("TBM01", "100", 3), ("TBM01", "200", 1), ("TBM02", "100", 2)])
    hauls = physical(spark, ["TBM01", ("TBM02", {"Zone": None, "Grid": None})])
    sites = distinct_sites(build_catch(select_samples(hauls), records, species_list(spark)))
    assert rows(sites) == [("TBM01", 0.5, 0.5, "A", 1), ("TBM02", 0.5, 0.5, None, None)]


def test_counts_per_haul_and_species(spark):
    records = numbers(
        spark,
        [
            ("a", "100", 3, "2", "3"),
            ("a", "100", 5),
            ("a", "200", 4, "N", "1"),
            ("a", NO_GEAR, 0),
            ("b", "9.998e+09", 0),
            ("c", "100", 1, "2", None),
            ("c", "100", 1),
            ("d", None, 1),
        ],
    )
    assert rows(combine_counts(records)) == [
        ("a", "100", 29.0),
        ("a", "200", 4.0),
        ("b", NO_FISH, 0.0),
        ("c", "100", None),
    ]


def test_prepared_counts(spark):
    records = numbers(spark, [("TBM01", "100", 3, "2", "1"), ("TBM01", "100", 1), ("TBM01", "400", 9), ("TBM01", "200", 2)])
    catch = build_catch(select_samples(physical(spark, ["TBM01"])), records, species_list(spark))
    got = prepare_counts(catch.withColumn("bay_segment", F.lit("OTB")), species(spark))
    assert rows(got, "Reference", "NODCCODE", "Total_N", "Bay", "Year", "Month", "Scientificname", "Hab_Cat") == [
        ("TBM01", "100", 7.0, "TB", 2000, 5, "Alpha", "B"),
        ("TBM01", "200", 2.0, "TB", 2000, 5, "Beta", "P"),
    ]
    assert [c for c in got.columns if c.lower() == "scientificname"] == ["Scientificname"]
    assert got.schema["Sampling_Date"].dataType.typeName() == "date"
