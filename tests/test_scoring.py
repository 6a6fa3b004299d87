import pytest

from haulscore.constants import INDEX_METRICS
from haulscore.operators import index_scores, metric_scores, reference_conditions
from helpers import rows

NAMES = list(INDEX_METRICS)


def metric_table(spark, hauls):
    """Hauls (reference, year, season, segment, value); every index metric has the same value unless a dict."""
    data = []
    for reference, year, season, segment, value in hauls:
        values = value if isinstance(value, dict) else dict.fromkeys(NAMES, value)
        data.append((reference, year, 1, season, segment, 0.0, 0.0, *[None if values[n] is None else float(values[n]) for n in NAMES]))
    columns = "Reference string, Year int, Month int, Season string, bay_segment string, Longitude double, Latitude double, "
    return spark.createDataFrame(data, columns + ", ".join(f"{n} double" for n in NAMES))


def conditions(spark, low, high, segment="OTB"):
    columns = ", ".join(f"{n}_P5 double, {n}_P95 double" for n in NAMES)
    return spark.createDataFrame(
        [(segment, "Winter", *[float(v) for _ in NAMES for v in (low, high)])], f"bay_segment string, Season string, {columns}"
    )


def score(spark, value, low, high, **options):
    hauls = metric_table(spark, [("a", 2000, "Winter", "OTB", value)])
    return metric_scores(hauls, conditions(spark, low, high), **options).first().asDict()


def test_reference_conditions_round_counts_only(spark):
    hauls = [(f"r{i}", 1998, "Winter", "OTB", v) for i, v in enumerate((1, 2, 3, 7, 10))]
    hauls += [("early", 1997, "Winter", "OTB", 99), ("late", 2016, "Winter", "OTB", 99), ("other", 2015, "Fall", None, 4)]
    got = {(r["bay_segment"], r["Season"]): r for r in reference_conditions(metric_table(spark, hauls)).collect()}
    assert set(got) == {("OTB", "Winter"), (None, "Fall")}
    main = got["OTB", "Winter"]
    assert (main["NumTaxa_P5"], main["NumTaxa_P95"]) == (1, 9)
    assert main["Shannon_P5"] == pytest.approx(1.2) and main["Shannon_P95"] == pytest.approx(9.4)
    assert got[None, "Fall"]["NumGuilds_P95"] == 4


def test_only_the_benthic_score_is_held_at_zero(spark):
    got = score(spark, 1, 2, 6)
    assert got["ScoreTaxaBenthic"] == 0
    assert {got[s] for s in INDEX_METRICS.values() if s != "ScoreTaxaBenthic"} == {-2}
    assert {score(spark, 1, 2, 6, clamp_all=True)[s] for s in INDEX_METRICS.values()} == {0}


@pytest.mark.parametrize(("value", "expected"), [(6, 10), (7, 10), (2, 0), (4, 5), (3, 2), (0, 0)])
def test_scale(spark, value, expected):
    assert set(score(spark, value, 2, 6)[s] for s in INDEX_METRICS.values()) == {expected}


def test_no_taxa_scores_zero_whatever_the_rest(spark):
    got = score(spark, dict.fromkeys(NAMES, 9) | {"NumTaxa": 0}, 2, 6)
    assert {got[s] for s in INDEX_METRICS.values()} == {0}


def test_empty_reference_range(spark):
    at = score(spark, 3, 3, 3)
    assert {at[s] for s in INDEX_METRICS.values()} == {None}
    below = score(spark, 2, 3, 3)
    assert below["ScoreTaxaBenthic"] == 0 and below["ScoreNumTaxa"] is None
    assert {score(spark, 4, 3, 3)[s] for s in INDEX_METRICS.values()} == {10}


def test_missing_condition_or_metric(spark):
    hauls = metric_table(spark, [("a", 2000, "Fall", "OTB", 3), ("b", 2000, "Fall", "OTB", 0), ("c", 2000, "Winter", "OTB", 4)])
    got = index_scores(metric_scores(hauls, conditions(spark, 2, 6)))
    assert rows(got, "Reference", "ScoreNumTaxa", "Index_Score") == [("a", None, None), ("b", 0, 0), ("c", 5, 50)]
    partial = index_scores(metric_scores(
        metric_table(spark, [("a", 2000, "Winter", "OTB", dict.fromkeys(NAMES, 4) | {"Shannon": None})]), conditions(spark, 2, 6)
    )).first()
    assert partial["ScoreShannon"] is None and partial["Index_Score"] is None and partial["ScoreNumTaxa"] == 5


def test_other_percentiles_keep_their_names(spark):
    hauls = metric_table(spark, [(f"r{i}", 2000, "Winter", "OTB", v) for i, v in enumerate(range(1, 10))])
    reference = reference_conditions(hauls, probs=(0.25, 0.95))
    assert "NumTaxa_P25" in reference.columns
    got = metric_scores(hauls, reference, (0.25, 0.95))
    assert rows(got.filter("Reference = 'r0'"), "ScoreNumTaxa", "ScoreTaxaBenthic") == [(-3, 0)]
