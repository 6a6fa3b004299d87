import numpy as np
import pytest
from pyspark.sql import functions as F

from haulscore.functions import exact_quantiles
from haulscore.functions import quantiles as module
from helpers import rows


@pytest.fixture(params=["built in", "bracketed"], autouse=True)
def way(request, monkeypatch):
    if request.param == "bracketed":
        monkeypatch.setattr(module, "SMALL_GROUP", -1)


def test_linear_interpolation(spark):
    frame = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 7, 10)], "x double")
    got = exact_quantiles(frame, [], ["x"], [0.05, 0.95]).first()
    assert got["x_P5"] == pytest.approx(1.2) and got["x_P95"] == pytest.approx(9.4)


def test_groups_match_numpy_and_a_missing_key_is_a_group(spark):
    generator = np.random.default_rng(7)
    data = []
    for key, size in (("a", 1), ("b", 2), ("c", 17), (None, 400), ("d", 1999)):
        for value in generator.normal(size=size):
            data.append((key, float(value), float(generator.integers(0, 6)), None if value > 1 else 1.5))
    frame = spark.createDataFrame(data, "k string, x double, n double, m double").repartition(7)
    probs = [0.0, 0.05, 0.33, 0.5, 0.95, 1.0]
    got = {r["k"]: r for r in exact_quantiles(frame, ["k"], ["x", "n", "m"], probs).collect()}
    assert set(got) == {"a", "b", "c", None, "d"}
    for key, row in got.items():
        for name, position in (("x", 1), ("n", 2), ("m", 3)):
            present = [r[position] for r in data if r[0] == key and r[position] is not None]
            for p in probs:
                value = row[f"{name}_P{p * 100:g}"]
                if present:
                    assert value == pytest.approx(np.quantile(present, p), abs=1e-12), (key, name, p)
                else:
                    assert value is None


@pytest.mark.parametrize("shape", ["continuous", "hot value", "outlier"])
def test_large_group_with_a_narrow_bracket(spark, shape):
    base = spark.range(0, 60_000, numPartitions=8).select(
        F.lit("g").alias("k"), (F.rand(3) * 100).alias("r"), F.col("id")
    )
    value = {
        "continuous": F.col("r"),
        "hot value": F.when(F.col("id") % 3 == 0, 40.0).otherwise(F.col("r")),
        "outlier": F.when(F.col("id") == 5, 1e300).otherwise(F.col("r")),
    }[shape]
    # Written once: the generator would give other numbers under another plan.
    frame = module.settle(base.select("k", value.alias("x")), "test-values")
    row = exact_quantiles(frame, ["k"], ["x"], [0.05, 0.33, 0.5, 0.95]).first()
    want = frame.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.05, 0.33, 0.5, 0.95)]))).first()[0]
    assert list(row[1:]) == pytest.approx(want, abs=1e-12)


def test_a_bracket_that_is_not_proven_is_widened(spark, monkeypatch):
    """With brackets of no width the proof fails for most ranks; the values stay exact."""
    monkeypatch.setattr(module, "REACH", 0.0)
    frame = spark.range(1, 1001).select((F.col("id") % 4).alias("k"), F.sqrt("id").alias("x"))
    got = {r["k"]: r["x_P95"] for r in exact_quantiles(frame, ["k"], ["x"], [0.95]).collect()}
    for key in range(4):
        present = [np.sqrt(i) for i in range(1, 1001) if i % 4 == key]
        assert got[key] == pytest.approx(np.quantile(present, 0.95), abs=1e-12)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert rows(exact_quantiles(empty, [], ["x"], [0.5])) == [(None,)]
    assert rows(exact_quantiles(empty, ["k"], ["x"], [0.5])) == []


def test_both_ways_give_the_same_bits(spark, monkeypatch):
    """Repeats, NaN, infinities, NULLs and fractions; brackets wide enough that ranges are searched."""
    generator = np.random.default_rng(3)
    odd = [float("nan"), float("inf"), float("-inf"), None]
    data = [("a", float(np.round(generator.normal(3, 1), 1))) for _ in range(1000)]
    data += [("b", v) for v in (1.0, float("nan"), 2.0)] + [("c", float(generator.choice([0.1, 0.7, 1 / 3, 3.1]))) for _ in range(400)]
    data += [("d", odd[i % 4] if i % 5 == 0 else float(i) / 7) for i in range(300)] + [("e", None), ("f", float("nan"))]
    frame = module.settle(spark.createDataFrame(data, "k string, x double").repartition(5), "odd-values")
    probs = [i / 100 for i in range(1, 100)]
    results = []
    for small, reach in ((200_000, module.REACH), (-1, module.REACH), (-1, 0.05), (-1, 0.0)):
        monkeypatch.setattr(module, "SMALL_GROUP", small)
        monkeypatch.setattr(module, "REACH", reach)
        found = exact_quantiles(frame, ["k"], ["x"], probs).collect()
        results.append({r["k"]: [None if v is None else np.float64(v).tobytes() for v in r[1:]] for r in found})
    assert results[0] == results[1] == results[2] == results[3]
