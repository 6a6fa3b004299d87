import pytest
from pyspark.sql import functions as F

from haulscore.functions import (
    bay_code,
    expanded_count,
    normalize_code,
    null_keeping_avg,
    null_keeping_sum,
    ratio,
    round_half_even,
    season,
    segment_name,
    zero_if,
)


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rounding_goes_to_the_even_number_and_has_no_negative_zero(spark):
    got = column(spark, [0.5, 1.5, 2.5, 3.5, -0.5, -1.5, None], "double", round_half_even)
    assert got == [0.0, 2.0, 2.0, 4.0, 0.0, -2.0, None]
    assert str(got[4]) == "0.0"


def test_ratio_has_no_value_for_zero_over_zero(spark):
    got = column(spark, [0.0, 2.0, None], "double", lambda v: ratio(v, v))
    assert got == [None, 1.0, None]


def test_codes_damaged_by_scientific_notation(spark):
    given = ["9.998e+09", "9.999e+09", "9998000000", "0012345678", "1E+3", "Anchoa e+x", None]
    assert column(spark, given, "string", normalize_code) == [
        "9998000000",
        "9999000000",
        "9998000000",
        "0012345678",
        "1000",
        "Anchoa e+x",
        None,
    ]


@pytest.mark.parametrize(
    ("split", "level", "expected"),
    [("2", "3", 24.0), ("", None, 3.0), ("N", "2", 3.0), (None, None, 3.0), ("2", None, None), ("2", "x", None), ("NaN", "1", 3.0)],
)
def test_expansion(spark, split, level, expected):
    frame = spark.createDataFrame([(3, split, level)], "n int, s string, l string")
    assert frame.select(expanded_count(F.col("n"), F.col("s"), F.col("l"))).first()[0] == expected


def test_seasons(spark):
    got = column(spark, [*range(1, 13), None], "int", season)
    assert got == ["Winter"] * 3 + ["Spring"] * 2 + ["Summer"] * 4 + ["Fall"] * 2 + ["Winter", None]


def test_segment_names(spark):
    assert column(spark, [1, 4, 5, 7, 8, None], "int", segment_name) == [
        "OTB",
        "LTB",
        "Boca Ceiga",
        "Manatee River",
        None,
        None,
    ]


def test_bay_code_and_zero_if(spark):
    assert column(spark, ["TBM001", None], "string", bay_code) == ["TB", None]
    assert column(spark, [0.0, 3.0, None], "double", lambda v: zero_if(v == 0, v + 1)) == [0.0, 4.0, None]


def test_missing_values_stay_missing_in_sums_and_means(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 3.0)], "k string, v double")
    got = frame.groupBy("k").agg(null_keeping_sum(F.col("v")), null_keeping_avg(F.col("v"))).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", None, None), ("b", 4.0, 2.0)]
