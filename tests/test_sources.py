import datetime
import glob

import pytest
from pyspark.sql import functions as F

from haulscore import schemas
from haulscore.sources import read_csv, read_jdbc, read_table, segments_from_vertices, write_csv, write_scores, write_table
from helpers import physical, plan_of, rows, square


def test_csv_quotes_missing_values_and_blanks(spark, tmp_path):
    path = tmp_path / "class.csv"
    path.write_text(
        "TSN,NODCCODE,ScientificName,Any_Index_Flag,Hab_Cat,Est_Cat,Est_Use,Feeding_Cat,Feeding_Guild,Selected_Taxa\n"
        '1,0012,"Say ""hé""",Y,B,NA,O,TS,,N\n',
        encoding="utf-8",
    )
    got = read_csv(spark, str(path), schemas.SPECIES_CLASS, blank_is_value=("Feeding_Guild",)).first()
    assert (got["NODCCODE"], got["ScientificName"]) == ("0012", 'Say "hé"')
    assert got["Est_Cat"] is None and got["Feeding_Guild"] == "" and got["Include_Index"] == "Y"


def test_blank_columns_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="TSN"):
        read_csv(spark, str(tmp_path), schemas.SPECIES_CLASS, blank_is_value=("TSN",))


def test_csv_round_trip_in_order(spark, tmp_path):
    path = str(tmp_path / "hauls")
    frame = physical(spark, ["b", ("a", {"Zone": None, "Stratum": 'x "y", z'})])
    write_csv(frame, path, order_by=["Reference"])
    back = read_csv(spark, path, schemas.PHYSICAL)
    assert rows(back) == rows(frame)
    first = sorted(glob.glob(f"{path}/*.csv"))[0]
    assert open(first, encoding="utf-8").read().splitlines()[1].startswith("a,")


def test_codes_stay_text(spark, tmp_path):
    path = tmp_path / "numbers.csv"
    path.write_text("Reference,Species_record_id,Splittype,Splitlevel,Cells,NODCCODE,Number,FHC\na,1,NA,NA,1,9998000000,0,F\n")
    got = read_csv(spark, str(path), schemas.NUMBERS).first()
    assert got["NODCCODE"] == "9998000000" and got["Splittype"] is None


def test_scores_are_named_after_their_years(spark, tmp_path):
    row = lambda year: ("r", year, 1, "Winter", "HB", 0.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 10.0)
    frame = spark.createDataFrame([row(1998), row(2018)], schemas.SCORES)
    path = write_scores(frame, str(tmp_path))
    assert path.endswith("/scores_1998-2018")
    assert rows(read_csv(spark, path, schemas.SCORES)) == rows(frame)
    stored = write_scores(frame, str(tmp_path / "stored"), fmt="parquet")
    one_year = read_table(spark, stored, schemas.SCORES).filter(F.col("Year") == 2018)
    assert one_year.count() == 1 and "PartitionFilters: [isnotnull(Year" in plan_of(one_year)


def test_orc_table(spark, tmp_path):
    frame = physical(spark, ["a"], Sampling_Date=datetime.datetime(2001, 1, 1))
    write_table(frame, str(tmp_path / "t"), fmt="orc")
    assert rows(read_table(spark, str(tmp_path / "t"), schemas.PHYSICAL, "orc")) == rows(frame)


def test_rings_are_ordered_and_named(spark):
    vertices = [*square(3, 0, 0, 4, 4), *square(3, 1, 1, 2, 2, ring_no=2), *square(9, 0, 0, 1, 1)]
    frame = spark.createDataFrame(vertices, schemas.VERTICES).orderBy(F.desc("vertex_no"))
    got = {r["segment_code"]: r for r in segments_from_vertices(frame).collect()}
    assert got[3]["bay_segment"] == "MTB" and got[9]["bay_segment"] is None
    assert [len(ring) for ring in got[3]["rings"]] == [5, 5]
    assert [(p["x"], p["y"]) for p in got[3]["rings"][0]] == [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]


def test_jdbc_needs_the_callers_options(spark):
    with pytest.raises(Exception, match="(?i)url|dbtable"):
        read_jdbc(spark, ["Reference"], driver="org.example.Driver")
