"""One query per operator over the survey tables derived from the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulscore.functions import calendar_date, expanded_count
from haulscore.functions.polygons import area, clip_rings, repair_rings
from haulscore.operators import (
    assign_segments,
    attach_segments,
    band_percentiles,
    build_catch,
    colour_class,
    compare_tables,
    distinct_sites,
    field_metadata,
    index_scores,
    metric_scores,
    override_segments,
    padded_extent,
    prepare_counts,
    quality_report,
    reference_conditions,
    sample_metrics,
    segment_scores,
    select_samples,
    with_bands,
    within_extent,
    year_map_samples,
    year_map_segments,
    yearly_scores,
)
from haulscore.operators.compare import compare_by_digests
from haulscore.operators.metrics import assemble, pick
from haulscore.operators.quality import write_checked
from haulscore.operators.states import (
    append_states,
    conditions_from_states,
    moment_states,
    segments_from_states,
    stored_states,
    value_states,
    yearly_from_states,
)
from haulscore.plans import SurveyTables, haul_metrics, run_index, score_hauls, survey_counts, survey_hauls
from haulscore.runtime import settle, shared_folder
from haulscore.sources import Colocated, open_colocated, read_csv, read_table, write_colocated, write_csv, write_scores, write_table

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# Order-dependent last bits of floating sums are rounded away before rows are compared.
DIGITS = 6


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.round(n, DIGITS) for n in names})


def _dated(frame: DataFrame) -> DataFrame:
    return frame.withColumn("Sampling_Date", F.to_date("Sampling_Date").cast("string"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_samples(fx.physical(spark, sf_dir), since=fx.SINCE)


def _catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fx.survey(spark, sf_dir)
    return build_catch(_samples(spark, sf_dir), tables.numbers, tables.species_list)


def _placed(spark: SparkSession, catch: DataFrame) -> DataFrame:
    return assign_segments(distinct_sites(catch), fx.segments(spark))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, _catch(spark, sf_dir))


def _catch_with_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catch table is read for its sites and again for its records, so it is written in between."""
    catch = settle(_catch(spark, sf_dir), "catch")
    return attach_segments(catch, override_segments(_placed(spark, catch)))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(haul_metrics(fx.survey(spark, sf_dir), fx.SETTINGS), "metrics")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_hauls(_metrics(spark, sf_dir), fx.SETTINGS)[1]


def _bands(scores: DataFrame) -> DataFrame:
    return band_percentiles(scores, fx.REFERENCE_YEARS)


def _picked(*names: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = pick(survey_counts(fx.survey(spark, sf_dir), fx.SETTINGS), names, fx.SENTINEL)
        return _rounded(metrics, *[n for n in names if n in ("Shannon", "Simpson", "Pielou") or n.startswith("Prop")])

    return query


def query_select_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(select_samples(fx.physical(spark, sf_dir)))


def query_build_catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(_catch(spark, sf_dir))


def query_distinct_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sites(_catch(spark, sf_dir))


def query_override_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return override_segments(_assigned(spark, sf_dir))


def query_override_segments_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return override_segments(_assigned(spark, sf_dir), axis="y", below=0.5)


def query_attach_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of all hauls, also of those without a record in the catch table."""
    catch = settle(_catch(spark, sf_dir), "catch")
    sites = fx.physical(spark, sf_dir).select("Reference", "Longitude", "Latitude", "Zone", "Grid")
    kept = override_segments(assign_segments(sites, fx.segments(spark)))
    return _dated(attach_segments(catch, settle(kept, "sites")))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/haulscore/{name}-{uuid.uuid4().hex}"


def _colocated(spark: SparkSession, hauls: DataFrame, records: DataFrame) -> Colocated:
    folder, buckets = _scratch(spark, "colocated"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_colocated(hauls, records, folder, buckets)
    return open_colocated(spark, folder, buckets)


def query_colocated_catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catch table from hauls and records stored by haul."""
    tables = fx.survey(spark, sf_dir)
    stored = _colocated(spark, tables.physical, tables.numbers)
    return _dated(stored.apply(lambda hauls, records: build_catch(select_samples(hauls, since=fx.SINCE), records, tables.species_list)))


def query_colocated_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments attached to records that are stored by haul beside the sites."""
    sites = fx.physical(spark, sf_dir).select("Reference", "Longitude", "Latitude", "Zone", "Grid")
    kept = override_segments(assign_segments(sites, fx.segments(spark)))
    stored = _colocated(spark, kept, _catch(spark, sf_dir))
    return _dated(stored.apply(lambda sites, catch: attach_segments(catch, sites, null_references=False)))


def query_assign_segments_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments from a layer given as polygon text."""
    return assign_segments(distinct_sites(_catch(spark, sf_dir)), fx.segments_as_text(spark))


def query_repaired_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments from a layer whose rings are open, turned and backwards, once it is repaired."""
    return assign_segments(distinct_sites(_catch(spark, sf_dir)), repair_rings(fx.damaged_segments(spark)))


def query_clipped_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer cut to the inner part of the hauls' extent, with the area that is left."""
    box = padded_extent(survey_hauls(fx.survey(spark, sf_dir), fx.SETTINGS), pad_x=-0.25, pad_y=-0.10)
    clipped = clip_rings(repair_rings(fx.damaged_segments(spark)), box)
    return clipped.select("segment_code", "bay_segment", F.round(area(), DIGITS).alias("area"))


def query_prepare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prepare_counts(_catch_with_segments(spark, sf_dir), fx.species(spark, sf_dir))
    return _dated(counts).drop("effort", "Project_1", "Project_2", "Project_3")


def _rounded_metrics(metrics: DataFrame) -> DataFrame:
    return _rounded(
        metrics, "Shannon", "Simpson", "Pielou", *[c for c in metrics.columns if c.startswith("Prop")]
    )


def query_sample_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_metrics(haul_metrics(fx.survey(spark, sf_dir), fx.SETTINGS))


def query_sample_metrics_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prepare_counts(_catch_with_segments(spark, sf_dir), fx.species(spark, sf_dir))
    return _rounded_metrics(sample_metrics(counts, fx.SENTINEL))


def query_survey_hauls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_hauls(fx.survey(spark, sf_dir), fx.SETTINGS)


def query_reference_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = reference_conditions(_metrics(spark, sf_dir), fx.REFERENCE_YEARS)
    return _rounded(conditions, "Shannon_P5", "Shannon_P95")


def _metric_scores(spark: SparkSession, sf_dir: str, probs: tuple[float, float]) -> DataFrame:
    metrics = _metrics(spark, sf_dir)
    conditions = settle(reference_conditions(metrics, fx.REFERENCE_YEARS, probs), "conditions")
    return metric_scores(metrics, conditions, probs)


def query_metric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_scores(spark, sf_dir, (0.05, 0.95))


def query_metric_scores_p25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_scores(spark, sf_dir, (0.25, 0.95))


def query_index_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(index_scores(query_metric_scores(spark, sf_dir)), "Index_Score")


def query_yearly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(yearly_scores(_scores(spark, sf_dir)), "SEM", "lower_sem", "upper_sem")


def query_segment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_scores(_scores(spark, sf_dir))


def query_band_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = _bands(settle(_scores(spark, sf_dir), "scores"))
    return _rounded(bands, "Score_P33", "Score_P50")


def query_banded_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = run_index(fx.survey(spark, sf_dir), fx.SETTINGS)
    return _rounded(tables.banded_years, "SEM", "lower_sem", "upper_sem", "Red", "Yellow")


def query_banded_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = settle(_scores(spark, sf_dir), "scores")
    return _rounded(with_bands(segment_scores(scores), _bands(scores)), "Red", "Yellow")


def query_colour_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _scores(spark, sf_dir)
    return scores.select("Reference", "Year", colour_class(F.col("Index_Score")).alias("MapCol"))


def query_year_map_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(year_map_samples(_scores(spark, sf_dir), fx.MAP_YEAR), "Index_Score")


def query_year_map_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_map_segments(_scores(spark, sf_dir), fx.segments(spark), fx.MAP_YEAR).drop("rings")


def query_padded_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    hauls = survey_hauls(fx.survey(spark, sf_dir), fx.SETTINGS)
    return _rounded(padded_extent(hauls), "xmin", "ymin", "xmax", "ymax")


def query_within_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fx.survey(spark, sf_dir)
    box = padded_extent(survey_hauls(tables, fx.SETTINGS), pad_x=-0.25, pad_y=-0.10)
    return within_extent(tables.physical.select("Reference", "Longitude", "Latitude"), box)


def _compared(spark: SparkSession, sf_dir: str, compare: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """What the metrics would be with subsamples left unexpanded, against the right ones."""
    tables = fx.survey(spark, sf_dir)
    raw = tables.numbers.withColumns({"Splittype": F.lit(None).cast("string"), "Splitlevel": F.lit(None).cast("string")})
    names = ["NumTaxa", "NumIndiv", "Shannon", "Taxa90"]
    left = pick(survey_counts(tables, fx.SETTINGS), [*names, "NumGuilds"], fx.SENTINEL)
    unexpanded = survey_counts(fx.replace_numbers(tables, raw), fx.SETTINGS)
    right = pick(unexpanded, names, fx.SENTINEL)

    def with_total(frame: DataFrame) -> DataFrame:
        """One row more, without a key: the largest values."""
        largest = frame.agg(*[F.max(c).alias(c) for c in frame.columns if c != "Reference"])
        return frame.unionByName(largest.withColumn("Reference", F.lit(None).cast("string")))

    left, right = with_total(left.filter("NumTaxa <> 1")), with_total(right.filter("NumTaxa <> 3"))
    differences = compare(_rounded(left, "Shannon"), _rounded(right, "Shannon"))
    return _rounded(
        differences.withColumns({v: F.round(F.col(v).cast("double"), DIGITS) for v in ("value_a", "value_b")}),
        "difference",
    )


def query_compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, compare_tables)


def query_compare_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, moving only the rows of key buckets whose checksums differ."""
    return _compared(spark, sf_dir, lambda a, b: compare_by_digests(settle(a, "compared"), settle(b, "compared")))


def query_expanded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and individuals per kind of subsample, before and after expansion."""
    records = fx.numbers(spark, sf_dir)
    count = expanded_count(F.col("Number"), F.col("Splittype"), F.col("Splitlevel"))
    return records.groupBy("Splittype", "Splitlevel").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("Number").cast("double").alias("counted"),
        F.sum(count).alias("expanded"),
    )


def query_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    flawed = settle(fx.flawed_catch(spark, sf_dir), "flawed-catch")
    return quality_report(flawed, fx.species_with_copies(spark, sf_dir))


def query_checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record checks, counted while the raw records are written."""
    path = _scratch(spark, "records")
    return write_checked(fx.flawed_catch(spark, sf_dir), lambda frame: write_table(frame, path))


def _damaged(spark: SparkSession, sf_dir: str) -> SurveyTables:
    return fx.replace_numbers(fx.survey(spark, sf_dir), fx.damaged_numbers(spark, sf_dir))


def query_damaged_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics from records with codes in scientific notation, by the fused chain."""
    return _rounded_metrics(haul_metrics(_damaged(spark, sf_dir), fx.SETTINGS))


def query_damaged_codes_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator by operator."""
    tables = _damaged(spark, sf_dir)
    catch = settle(build_catch(_samples(spark, sf_dir), tables.numbers, tables.species_list), "catch")
    counts = prepare_counts(attach_segments(catch, override_segments(_placed(spark, catch))), tables.species)
    return _rounded_metrics(sample_metrics(counts, fx.SENTINEL))


def query_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric tables made one by one and joined by haul."""
    counts = settle(survey_counts(fx.survey(spark, sf_dir), fx.SETTINGS), "counts")
    groups = (["NumTaxa", "NumIndiv"], ["Shannon"], ["TaxaSelect", "SelectIndiv"], ["NumGuilds"], ["Taxa90"])
    return _rounded(assemble(*[pick(counts, names, fx.SENTINEL) for names in groups]), "Shannon")


def query_csv_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class table written as CSV and read again; blank codes stay blank."""
    path = f"{shared_folder(spark).rstrip('/')}/haulscore/csv-{uuid.uuid4().hex}"
    classed = fx.species(spark, sf_dir)
    write_csv(classed, path, order_by=["NODCCODE"])
    return read_csv(spark, path, classed.schema, blank_is_value=("Est_Cat", "Feeding_Guild"))


def query_csv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written under the name of their years and read again, with the name."""
    scores = settle(query_index_scores(spark, sf_dir), "scores")
    path = write_scores(scores, f"{shared_folder(spark).rstrip('/')}/haulscore/csv-{uuid.uuid4().hex}")
    return read_csv(spark, path, scores.schema).withColumn("file", F.lit(path.rpartition("/")[2]))


def query_csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas, line breaks, blanks and ``NA`` written as CSV and read again, whole."""
    texts, path = fx.hostile_texts(spark, sf_dir), _scratch(spark, "csv")
    write_csv(texts, path, whole_text=True)
    return read_csv(spark, path, texts.schema, whole_text=True)


def query_site_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites with their segments as a stored table, read again."""
    path = _scratch(spark, "sites")
    write_table(override_segments(_assigned(spark, sf_dir)), path, ["bay_segment"])
    return read_table(spark, path).select("Reference", "Longitude", "Latitude", "Zone", "Grid", "bay_segment")


def query_date_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = calendar_date(F.col("Sampling_Date"))
    return fx.spelled_dates(spark, sf_dir).select("Reference", date.cast("string").alias("Sampling_Date"), F.year(date).alias("Year"), F.month(date).alias("Month"))


def _refreshed(spark: SparkSession, frame: DataFrame, states: Callable[[DataFrame], DataFrame], kind: str) -> DataFrame:
    """States stored for all years but the last, then those of the last year's rows merged in."""
    folder = _scratch(spark, "states")
    last = frame.agg(F.max("Year")).first()[0]
    append_states(states(frame.where(F.col("Year") < last)), folder, kind)
    append_states(states(frame.where(F.col("Year") == last)), folder, kind)
    return stored_states(spark, folder, kind)


def query_refreshed_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _refreshed(spark, _metrics(spark, sf_dir), value_states, "values")
    return _rounded(conditions_from_states(values, fx.REFERENCE_YEARS), "Shannon_P5", "Shannon_P95")


def query_refreshed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = _refreshed(spark, settle(_scores(spark, sf_dir), "scores"), moment_states, "moments")
    return _rounded(yearly_from_states(moments), "SEM", "lower_sem", "upper_sem")


def query_refreshed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments_from_states(_refreshed(spark, settle(_scores(spark, sf_dir), "scores"), moment_states, "moments"))


def query_field_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("Brand#2", "Brand#11", "Brand#12", "Brand#23")
    metadata = field_metadata(fx.field_descriptions(spark, sf_dir), wanted)
    return metadata.toDF(*[name.replace(".", "_") for name in metadata.columns])


QUERIES: dict[str, Query] = {
    "select_samples": query_select_samples,
    "build_catch": query_build_catch,
    "distinct_sites": query_distinct_sites,
    "assign_segments": _assigned,
    "override_segments": query_override_segments,
    "override_segments_documented": query_override_segments_documented,
    "attach_segments": query_attach_segments,
    "expanded_counts": query_expanded_counts,
    "prepare_counts": query_prepare_counts,
    "num_taxa": _picked("NumTaxa"),
    "num_indiv": _picked("NumIndiv"),
    "diversity": _picked("Shannon", "Simpson", "Pielou"),
    "dominance_taxa90": _picked("Taxa90"),
    "taxa_select": _picked("TaxaSelect", "SelectIndiv"),
    "num_guilds": _picked("NumGuilds"),
    "guild_taxa": _picked("TSTaxa", "TGTaxa", "BenthicTaxa", "PelagicTaxa", "OblTaxa", "MSTaxa", "ESTaxa"),
    "guild_abundance": _picked(
        "TSAbund", "TGAbund", "BenthicAbund", "PelagicAbund", "OblAbund", "ESAbund", "MSAbund"
    ),
    "sentinel_abundance": _picked("Num_LR"),
    "proportions": _picked(
        "PropTG", "PropTS", "PropBenthic", "PropPelagic", "PropObl", "PropMS", "PropES", "PropSelect"
    ),
    "survey_hauls": query_survey_hauls,
    "sample_metrics": query_sample_metrics,
    "sample_metrics_stepwise": query_sample_metrics_stepwise,
    "reference_conditions": query_reference_conditions,
    "metric_scores": query_metric_scores,
    "metric_scores_p25": query_metric_scores_p25,
    "index_scores": query_index_scores,
    "yearly_scores": query_yearly_scores,
    "segment_scores": query_segment_scores,
    "band_percentiles": query_band_percentiles,
    "banded_years": query_banded_years,
    "banded_segments": query_banded_segments,
    "colour_classes": query_colour_classes,
    "year_map_samples": query_year_map_samples,
    "year_map_segments": query_year_map_segments,
    "padded_extent": query_padded_extent,
    "within_extent": query_within_extent,
    "compare_tables": query_compare_tables,
    "quality_report": query_quality_report,
    "field_metadata": query_field_metadata,
    "assign_segments_text": query_assign_segments_text,
    "damaged_codes": query_damaged_codes,
    "damaged_codes_stepwise": query_damaged_codes_stepwise,
    "assemble": query_assemble,
    "csv_species": query_csv_species,
    "csv_scores": query_csv_scores,
    "repaired_segments": query_repaired_segments,
    "clipped_segments": query_clipped_segments,
    "csv_texts": query_csv_texts,
    "site_table": query_site_table,
    "date_spellings": query_date_spellings,
    "compare_by_digests": query_compare_by_digests,
    "refreshed_conditions": query_refreshed_conditions,
    "refreshed_years": query_refreshed_years,
    "refreshed_segments": query_refreshed_segments,
    "checked_write": query_checked_write,
    "colocated_catch": query_colocated_catch,
    "colocated_segments": query_colocated_segments,
}
