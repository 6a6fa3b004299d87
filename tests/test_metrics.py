import math
import random

import pytest
from pyspark.sql import functions as F

from haulscore.functions import ratio
from haulscore.operators import METRICS, assemble, sample_metrics
from haulscore.operators.metrics import ATTRIBUTES, ORDERED, pick
from helpers import NO_FISH, SPECIES, counts, plan_of, rows


def metrics_of(spark, records, sentinel="Alpha"):
    got = sample_metrics(counts(spark, records), sentinel)
    return {r["Reference"]: r.asDict() for r in got.collect()}


def test_two_even_taxa(spark):
    m = metrics_of(spark, [("a", "100", 5), ("a", "200", 5)])["a"]
    assert (m["NumTaxa"], m["NumIndiv"], m["Simpson"]) == (2, 10, 2)
    assert m["Shannon"] == pytest.approx(math.log(2)) and m["Pielou"] == pytest.approx(1)
    assert (m["TaxaSelect"], m["SelectIndiv"], m["PropSelect"]) == (1, 5, 0.5)
    assert (m["BenthicTaxa"], m["PelagicTaxa"], m["TSTaxa"], m["TGTaxa"]) == (1, 1, 1, 1)
    assert (m["OblTaxa"], m["MSTaxa"], m["ESTaxa"], m["Num_LR"]) == (1, 1, 1, 5)


def test_one_taxon_has_no_evenness(spark):
    m = metrics_of(spark, [("a", "200", 4)])["a"]
    assert (m["Shannon"], m["Simpson"], m["Pielou"], m["Taxa90"]) == (0, 1, None, 1)
    assert (m["SelectIndiv"], m["PropSelect"], m["Num_LR"]) == (0, 0, 0)
    assert str(m["Shannon"]) == "0.0"


@pytest.mark.parametrize(("totals", "expected"), [((6, 3, 1), 2), ((9, 1, 0), 1), ((1, 1, 1), 3), ((10, 0, 0), 1)])
def test_taxa_that_make_up_ninety_percent(spark, totals, expected):
    m = metrics_of(spark, [("a", code, n) for code, n in zip(("100", "200", "300"), totals)])["a"]
    assert m["Taxa90"] == expected


def test_a_haul_without_fish_is_zero_in_every_metric(spark):
    m = metrics_of(spark, [("a", NO_FISH, 0)])["a"]
    assert {m[name] for name in METRICS} == {0}


def test_blank_and_odd_guilds_count_as_guilds(spark):
    assert metrics_of(spark, [("a", "100", 1), ("a", "300", 1)])["a"]["NumGuilds"] == 2
    m = metrics_of(spark, [("a", "100", 1), ("a", "300", 1), ("a", "500", 1)])["a"]
    assert (m["NumGuilds"], m["TSTaxa"]) == (3, 2)


def test_fish_beside_a_no_fish_record_stay_one_haul(spark):
    m = metrics_of(spark, [("a", NO_FISH, 0), ("a", "100", 2)])
    assert list(m) == ["a"] and m["a"]["NumTaxa"] == 1 and m["a"]["NumIndiv"] == 2


def test_a_species_counted_zero_adds_nothing_to_diversity(spark):
    m = metrics_of(spark, [("a", "100", 5), ("a", "200", 5), ("a", "300", 0)])["a"]
    assert m["Shannon"] == pytest.approx(math.log(2)) and m["NumTaxa"] == 3


def test_a_missing_total_makes_the_sums_missing(spark):
    m = metrics_of(spark, [("a", "100", None), ("a", "200", 5), ("b", "100", 1)])
    assert m["a"]["NumTaxa"] == 2 and m["a"]["BenthicTaxa"] == 1
    for name in ("NumIndiv", "Shannon", "Simpson", "Pielou", "Taxa90", "TGAbund", "PelagicAbund", "PropTG"):
        assert m["a"][name] is None, name
    assert (m["a"]["SelectIndiv"], m["a"]["PropSelect"], m["a"]["Num_LR"]) == (0, 0, 0)
    assert m["b"]["NumIndiv"] == 1


def test_attributes_are_kept_and_give_the_season(spark):
    frame = counts(spark, [("a", "100", 1), ("b", "200", 1)]).withColumns(
        {
            "Year": F.lit(2001),
            "Month": F.when(F.col("Reference") == "a", 12).otherwise(6),
            "bay_segment": F.lit("HB"),
            "Longitude": F.lit(1.0),
            "Latitude": F.lit(None).cast("double"),
        }
    )
    got = sample_metrics(frame)
    assert got.columns[:7] == ["Reference", "Year", "Month", "Season", "bay_segment", "Longitude", "Latitude"]
    assert set(ATTRIBUTES) <= set(got.columns) and len(METRICS) == 32
    assert rows(got, "Reference", "Season", "Latitude") == [("a", "Winter", None), ("b", "Summer", None)]


CODES = {code: record for record in SPECIES for code in [record[1]] if record[3] == "Y" and code != NO_FISH}


def brute(records):
    """All metrics of one haul in plain Python."""
    kept = [(CODES[c], n) for c, n in records]
    total = sum(n for _, n in kept)
    if total == 0:
        return dict.fromkeys(METRICS, 0.0)
    shares = [n / total for _, n in kept if n]
    shannon = -sum(p * math.log(p) for p in shares)
    flags = {"TS": (7, "TS"), "TG": (7, "TG"), "Benthic": (4, "B"), "Pelagic": (4, "P"), "Obl": (6, "O"), "MS": (5, "MS"), "ES": (5, "ES")}
    out = {
        "NumTaxa": len(kept),
        "NumIndiv": total,
        "Shannon": shannon,
        "Simpson": 1 / sum(p * p for p in shares),
        "Pielou": shannon / math.log(len(kept)) if len(kept) > 1 else None,
        "TaxaSelect": sum(s[9] == "Y" for s, _ in kept),
        "SelectIndiv": sum(n for s, n in kept if s[9] == "Y"),
        "NumGuilds": len({s[8] for s, _ in kept}),
        "Num_LR": sum(n for s, n in kept if s[2] == "Alpha"),
    }
    running = 0
    for place, n in enumerate(sorted((n for _, n in kept), reverse=True), 1):
        running += n
        if running / total >= 0.9:
            out["Taxa90"] = place
            break
    for name, (at, code) in flags.items():
        out[f"{name}Taxa"] = sum(s[at] == code for s, _ in kept)
        out[f"{name}Abund"] = sum(n for s, n in kept if s[at] == code)
        out[f"Prop{name}"] = out[f"{name}Abund"] / total
    out["PropSelect"] = out["SelectIndiv"] / total
    return out


def test_random_hauls_against_plain_python(spark):
    generator = random.Random(11)
    hauls = {
        f"h{i}": [(c, generator.choice([0, 1, 1, 2, 7, 300])) for c in generator.sample(sorted(CODES), generator.randint(1, len(CODES)))]
        for i in range(150)
    }
    records = [(h, c, n) for h, kept in hauls.items() for c, n in kept]
    frame = counts(spark, records)
    got = {r["Reference"]: r.asDict() for r in sample_metrics(frame, "Alpha").collect()}
    assert len(got) == len(hauls)
    for haul, kept in hauls.items():
        want = brute(kept)
        for name in METRICS:
            assert got[haul][name] == (want[name] if want[name] is None else pytest.approx(want[name], abs=1e-12)), (haul, name)
        if got[haul]["NumIndiv"] > 0:
            assert got[haul]["Shannon"] <= math.log(got[haul]["NumTaxa"]) + 1e-12
            assert 1 - 1e-12 <= got[haul]["Simpson"] <= got[haul]["NumTaxa"] + 1e-12
            assert got[haul]["Taxa90"] <= got[haul]["NumTaxa"]
            assert all(0 <= got[haul][m] <= 1 for m in METRICS if m.startswith("Prop"))
    shuffled = {r["Reference"]: r.asDict() for r in sample_metrics(frame.orderBy(F.rand(5)).repartition(5), "Alpha").collect()}
    for haul in hauls:
        assert shuffled[haul] == pytest.approx(got[haul])


def test_many_equal_taxa_are_one_row_when_collapsed(spark):
    """A haul with thousands of species, most of them with one of a few totals."""
    totals = [1.0] * 3000 + [2.0] * 500 + [1000.0] * 3 + [3.0]
    frame = spark.createDataFrame([("a", f"{i}", t, f"S{i}", "B", "MS", "O", "TS", "ZB", "N") for i, t in enumerate(totals)],
        "Reference string, NODCCODE string, Total_N double, Scientificname string, Hab_Cat string, Est_Cat string, "
        "Est_Use string, Feeding_Cat string, Feeding_Guild string, Selected_Taxa string")
    share, running = sorted(totals, reverse=True), 0.0
    for place, n in enumerate(share, 1):
        running += n
        if running / sum(totals) >= 0.9:
            break
    got = sample_metrics(frame).first()
    assert got["Taxa90"] == place and got["NumTaxa"] == len(totals) and got["NumIndiv"] == sum(totals)


def test_dominance_of_fractional_totals(spark):
    """Totals scaled down by a subsample level below zero, with running sums on and beside the threshold."""
    hauls = {"a": [0.1] * 10, "b": [0.25] * 3 + [0.125] * 2, "c": [1 / 3] * 9 + [1 / 3], "d": [4.5, 0.25, 0.25], "e": [0.9, 0.1]}
    frame = spark.createDataFrame(
        [(h, f"{i}", t, f"S{i}", "B", "MS", "O", "TS", "ZB", "N") for h, totals in hauls.items() for i, t in enumerate(totals)],
        "Reference string, NODCCODE string, Total_N double, Scientificname string, Hab_Cat string, Est_Cat string, "
        "Est_Use string, Feeding_Cat string, Feeding_Guild string, Selected_Taxa string",
    )
    first = {r["Reference"]: r.asDict() for r in sample_metrics(frame).collect()}
    again = {r["Reference"]: r.asDict() for r in sample_metrics(frame.repartition(6, "NODCCODE")).collect()}
    assert {h: r["Taxa90"] for h, r in first.items()} == {"a": 9, "b": 5, "c": 9, "d": 1, "e": 1}
    assert first == again


@pytest.mark.parametrize("name", [m for m in METRICS if m not in ORDERED])
def test_plain_sums_need_no_window(spark, name):
    plan = plan_of(sample_metrics(counts(spark, [("a", "100", 5)]), wanted=[name]))
    assert "Window" not in plan and "partial_" in plan


def test_wanted_metrics_are_the_same_alone(spark):
    frame = counts(spark, [("a", "100", 5), ("a", "200", 5), ("b", "200", 4), ("c", "100", None), ("c", "200", 1), ("d", NO_FISH, 0)])
    everything = {r["Reference"]: r.asDict() for r in sample_metrics(frame, "Alpha").collect()}
    for name in METRICS:
        assert {r["Reference"]: r[name] for r in pick(frame, [name], "Alpha").collect()} == {h: r[name] for h, r in everything.items()}, name


def test_joining_metric_tables_gives_the_same(spark):
    frame = counts(spark, [("a", "100", 5), ("a", "200", 5), ("b", "200", 4)])
    total = frame.groupBy("Reference").agg(F.sum("Total_N").alias("NumIndiv"))
    taxa = frame.groupBy("Reference").agg(F.count(F.lit(1)).cast("double").alias("NumTaxa"))
    benthic = frame.filter("Hab_Cat = 'B'").groupBy("Reference").agg(F.sum("Total_N").alias("BenthicAbund"))
    joined = assemble(taxa, total, benthic).withColumn("PropBenthic", ratio(F.coalesce("BenthicAbund", F.lit(0.0)), F.col("NumIndiv")))
    names = ("Reference", "NumTaxa", "NumIndiv", "PropBenthic")
    assert rows(joined, *names) == rows(sample_metrics(frame), *names)
