"""How plans behave at size: shuffles, hot keys, lookups too large to broadcast, written tables."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from haulscore import runtime, schemas
from haulscore.operators import (
    assign_segments,
    build_catch,
    combine_counts,
    metric_scores,
    override_segments,
    prepare_counts,
    attach_segments,
    distinct_sites,
    sample_metrics,
    select_samples,
    with_classes,
)
from haulscore.functions.prefix import running_sums
from haulscore.operators.metrics import pick
from haulscore.plans import IndexSettings, SurveyTables, haul_metrics, run_index
from haulscore.runtime import fits_broadcast, lookup_join, settle, shared_folder
from helpers import SPECIES, counts, initial_plan, layer, numbers, physical, plan_of, rows, species, species_list, square

SQUARES = [(1, 0, 0, 2, 2), (2, 2, 0, 4, 2), (3, 0, 2, 2, 4), (4, 2, 2, 4, 4), (5, 4, 0, 6, 4)]


def survey(spark) -> SurveyTables:
    """About 400 hauls on a lattice in two years and four seasons, with splits, repeats and empty hauls."""
    import datetime

    codes = [s[1] for s in SPECIES[:5]]
    hauls, records = [], []
    for i in range(400):
        reference = f"{'TBM' if i % 9 else 'CKM'}{i:04d}"
        month = (1, 4, 7, 10)[i % 4]
        place = {"Longitude": 0.25 + (i * 7 % 13) * 0.5, "Latitude": 0.25 + (i * 5 % 9) * 0.5, "Grid": 200 + i % 170}
        hauls.append((reference, {"Sampling_Date": datetime.datetime(2000 + i % 2, month, 1 + i % 28), **place}))
        if i % 10 == 3:
            records.append((reference, "9998000000", 0))
            continue
        for k in range(1 + i % 6):
            split = (("2", "2"), ("N", None), (None, None))[(i + k) % 3]
            records.append((reference, codes[(i * 3 + k * k) % 5], 1 + (i * 11 + k * 5) % 40, *split, "D" if (i + k) % 17 == 0 else "F"))
    return SurveyTables(
        physical=physical(spark, hauls),
        numbers=numbers(spark, records),
        species_list=species_list(spark),
        species=species(spark),
        segments=layer(spark, *[square(*s) for s in SQUARES]),
    )


SETTINGS = IndexSettings(cell_edges=4, sentinel="Alpha")


@pytest.fixture
def stored(spark):
    tables = survey(spark)
    return SurveyTables(**{n: settle(getattr(tables, n), n) for n in ("physical", "numbers", "species_list", "species", "segments")})


@pytest.fixture
def whole_plan(monkeypatch):
    """Leaves the written rows of the metrics out, so that one plan shows the chain."""
    monkeypatch.setattr("haulscore.operators.metrics.settle", lambda frame, name: frame)


def by_key(frame, key="Reference"):
    return {r[key]: r.asDict() for r in frame.collect()}


def test_one_sort_for_all_metrics_and_equal_rows_counted_before_it(spark, whole_plan):
    frame = settle(counts(spark, [("a", "100", 5), ("a", "200", 5), ("b", "200", 4)]), "counts")
    plan = plan_of(sample_metrics(frame))
    assert len(re.findall(r"Exchange hashpartitioning\(Reference", plan)) == 2
    assert plan.count("Exchange") == 2 and len(re.findall(r"- Sort ", plan)) == 1
    assert "partial_count" in plan.split("Exchange")[2] and "Expand" not in plan


def test_over_large_class_table_collapses_a_haul_for_every_caller(spark, whole_plan):
    """A haul of many species with few different totals has few rows where it is put in order, for each of the ordered metrics."""
    codes = [(i, f"{i}", f"S{i}", "Y", "B", "MS", "O", "TS", "ZB", "N") for i in range(3000)]
    classes = spark.createDataFrame(codes, schemas.SPECIES_CLASS)
    totals = spark.createDataFrame([("a", f"{i}", float(1 + i % 3), f"S{i}") for i in range(3000)], "Reference string, NODCCODE string, Total_N double, Scientificname string")
    frame = with_classes(totals, classes)
    for wanted in (["Shannon"], ["Taxa90"], None):
        whole = sample_metrics(frame, **({"wanted": wanted} if wanted else {}))
        assert re.search(r"Window.*\n(.*\n)*?.*Exchange.*\n(.*\n)*?.*HashAggregate.*count", plan_of(whole))
        assert whole.count() == 1
    assert sample_metrics(frame).first()["NumTaxa"] == 3000


def test_records_are_summed_before_the_shuffle(spark, stored):
    plan = plan_of(combine_counts(stored.numbers.drop("FHC")))
    assert re.search(r"Exchange hashpartitioning\(Reference\S+, NODCCODE.*\n.*HashAggregate\(keys=\[Reference\S+, NODCCODE.*partial_sum", plan)
    assert plan.count("Exchange") == 1


def test_the_whole_chain_shuffles_records_once_and_totals_once(spark, stored, conf, whole_plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(haul_metrics(stored, SETTINGS))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert sorted(exchanges) == ["Reference"] * 4
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_needed_columns_only(spark, stored, conf, whole_plan):
    conf("spark.sql.maxMetadataStringLength", "4000")
    plan = plan_of(haul_metrics(stored, SETTINGS))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(set(re.findall(r"(\w+):", r)) == {"Reference", "Splittype", "Splitlevel", "NODCCODE", "Number", "FHC"} for r in reads)
    assert "StringStartsWith(Reference,TBM)" in plan


def test_single_metrics_prune_the_rest(spark, stored):
    frame = with_classes(combine_counts(stored.numbers.drop("FHC")).withColumn("Scientificname", F.lit("Alpha")), stored.species)
    plan = plan_of(pick(frame, ["NumTaxa"]))
    assert "guild" not in plan and "is_Pelagic" not in plan


def test_stepwise_and_whole_chain_agree(spark, stored):
    samples = select_samples(stored.physical)
    catch = build_catch(samples, stored.numbers, stored.species_list)
    sites = override_segments(assign_segments(distinct_sites(catch), stored.segments, 4))
    stepwise = sample_metrics(prepare_counts(attach_segments(catch, sites), stored.species), "Alpha")
    whole = haul_metrics(stored, SETTINGS)
    assert stepwise.columns == whole.columns
    left, right = by_key(stepwise), by_key(whole)
    assert len(left) > 150 and left.keys() == right.keys()
    for key, row in left.items():
        assert row == pytest.approx(right[key])


def test_results_without_any_broadcast(spark, stored, conf, monkeypatch):
    small = run_index(stored, SETTINGS)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", -1)
    large = run_index(stored, SETTINGS)
    plan = plan_of(haul_metrics(stored, SETTINGS))
    assert "Broadcast" not in plan and "_salt" in plan
    left, right = by_key(large.metrics), by_key(small.metrics)
    assert left.keys() == right.keys() and left
    assert all(left[r] == pytest.approx(right[r]) for r in left)
    assert by_key(large.scores) == by_key(small.scores)
    assert rows(large.conditions) == rows(small.conditions)
    left, right = (by_key(t.banded_years, "Year") for t in (large, small))
    assert left.keys() == right.keys() and all(left[y] == pytest.approx(right[y]) for y in left)


def test_a_hot_key_of_a_large_lookup_is_spread(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = fact.select("k").distinct().withColumn("name", F.upper("k"))
    joined = lookup_join(fact, lookup, ["k"], "left", max_bytes=0)
    assert joined.columns == ["id", "k", "name"] and joined.count() == 3000
    assert joined.filter("name IS NULL OR name <> upper(k)").count() == 0
    spread = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 5 and max(r["count"] for r in spread) < 500


def test_copies_of_a_large_lookup_are_not_broadcast(spark, conf, tmp_path):
    """Spark estimates a look-up by its compressed files, however many rows and copies they unfold to."""
    conf("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    path = str(tmp_path / "lookup")
    spark.range(50_000).select("id", F.lit("a name that repeats").alias("name")).write.parquet(path)
    fact = spark.range(60_000).select((F.col("id") % 55_000).alias("id"))
    for how, count in (("inner", 55_000), ("left", 60_000)):
        joined = lookup_join(fact, spark.read.parquet(path), ["id"], how, max_bytes=0)
        assert joined.count() == count and joined.where("name IS NOT NULL").count() == 55_000
        assert "Broadcast" not in initial_plan(joined) and "Broadcast" not in plan_of(joined)


def test_a_haul_of_many_different_totals_is_spread_over_tasks(spark, monkeypatch):
    """A third of all rows in one haul, each total its own: no task ranks more than a few blocks of it, and the metrics stay what they are."""
    ids = spark.range(0, 9000, numPartitions=4)
    frame = settle(
        ids.select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), (F.col("id") % 40).cast("string"))).alias("Reference"),
            (F.lit(100) + F.col("id")).cast("string").alias("NODCCODE"),
            F.concat(F.lit("S"), F.col("id").cast("string")).alias("Scientificname"),
            (F.col("id") * 0.37 + 1 / (F.col("id") + 1)).alias("Total_N"),
            *[F.lit(v).alias(c) for c, v in (("Selected_Taxa", "Y"), ("Feeding_Guild", "ZB"), ("Hab_Cat", "B"), ("Est_Cat", "MS"), ("Est_Use", "O"), ("Feeding_Cat", "TS"))],
        ),
        "hot-haul",
    )
    plain = by_key(sample_metrics(frame))
    monkeypatch.setattr("haulscore.operators.metrics.BLOCK_ROWS", 250)
    spread = sample_metrics(frame)
    assert by_key(spread).keys() == plain.keys() and len(plain) == 41
    for haul, row in by_key(spread).items():
        assert row.pop("Reference") == plain[haul].pop("Reference") and row["Taxa90"] == plain[haul]["Taxa90"]
        assert row == pytest.approx(plain[haul], rel=1e-12)
    missing = settle(frame.withColumn("Total_N", F.when(F.col("NODCCODE") != "400", F.col("Total_N"))), "missing")
    row = by_key(sample_metrics(missing))["hot"]
    assert row["NumIndiv"] is None and row["Shannon"] is None and row["Taxa90"] is None and row["NumTaxa"] == 3000


def test_running_sums_by_blocks(spark):
    rng = random.Random(4)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(50)]), rng.randint(0, 9)) for _ in range(2000)]
    frame = settle(spark.createDataFrame(data, "k string, v int, n long"), "running")
    got = running_sums(frame, "k", "v", ["n"], block_rows=60)
    blocks = got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(blocks) >= 4
    for key in ("hot", "a", "b", None):
        mine = [(v, n) for k, v, n in data if k == key]
        seen = got.where(F.col("k").eqNullSafe(F.lit(key))).select("v", "n", "n_through", "n_total").collect()
        assert len(seen) == len(mine) and {r.n_total for r in seen} == {sum(n for _, n in mine)}
        for r in seen:
            above = sum(n for v, n in mine if v is not None and (r.v is None or v > r.v))
            upto = above + sum(n for v, n in mine if v == r.v)
            assert above + r.n <= r.n_through <= upto
        assert len({r.n_through for r in seen if r.n}) == sum(1 for _, n in mine if n)


def test_lookup_size_is_measured(spark):
    frame = spark.range(1000)
    assert fits_broadcast(frame) and not fits_broadcast(frame, 1000) and fits_broadcast(frame.limit(0), 0)


def test_a_grown_lookup_is_measured_again(spark, tmp_path):
    path = str(tmp_path / "grows")
    spark.range(10).write.parquet(path)
    assert fits_broadcast(spark.read.parquet(path), 2000)
    spark.range(100_000).write.mode("append").parquet(path)
    assert not fits_broadcast(spark.read.parquet(path), 2000)


def test_a_hot_haul_is_split_in_the_record_join(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    ids = spark.range(0, 60_000, numPartitions=8)
    reference = F.when(F.col("id") % 3 == 0, "TBM00000").otherwise(F.format_string("TBM%05d", F.col("id") % 2000))
    record = ids.select(
        reference.alias("Reference"),
        F.col("id").cast("int").alias("Species_record_id"),
        F.lit(None).cast("string").alias("Splittype"),
        F.lit(None).cast("string").alias("Splitlevel"),
        F.lit(1).alias("Cells"),
        F.when(F.col("id") % 2 == 0, "100").otherwise("200").alias("NODCCODE"),
        F.lit(1).alias("Number"),
        F.lit("F").alias("FHC"),
    )
    samples = select_samples(physical(spark, [f"TBM{i:05d}" for i in range(2000)]))
    catch = build_catch(samples, record, species_list(spark))
    assert len(catch.collect()) == 60_000
    assert "skew=true" in plan_of(catch)
    totals = by_key(combine_counts(record).groupBy("Reference").agg(F.sum("Total_N").alias("n"), F.count(F.lit(1)).alias("species")))
    assert totals["TBM00000"]["n"] == 20_000 + 20 and totals["TBM00000"]["species"] == 2


def test_scores_join_conditions_without_moving_hauls(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    done = run_index(stored, SETTINGS)
    plan = plan_of(metric_scores(done.metrics, done.conditions))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_spatial_lookup_moves_no_site(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(assign_segments(stored.physical, stored.segments, 4))
    # The cells are a written table, measured and broadcast.
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "NestedLoop" not in plan


def test_top_results_use_scalar_subqueries(spark, stored):
    plan = initial_plan(run_index(stored, SETTINGS).banded_years)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_settled_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    frame = settle(spark.createDataFrame([(1, "a"), (2, None)], "n int, s string"), "two")
    assert folder in plan_of(frame) and frame.schema == spark.createDataFrame([], "n int, s string").schema
    assert rows(frame) == [(1, "a"), (2, None)]


def test_the_library_keeps_to_the_engine():
    """No Python functions over rows, no lineage on executors' disks, no cross joins, no gathering of tables."""
    root = Path(runtime.__file__).parent
    text = "\n".join(p.read_text() for p in root.rglob("*.py"))
    for banned in ("udf", "localCheckpoint", "crossJoin", ".collect(", "toPandas", "mapPartitions", "applyInPandas", ".rdd"):
        assert banned not in text, banned


def test_schemas_name_the_output_columns(spark, stored):
    done = run_index(stored, SETTINGS)
    assert done.scores.columns == schemas.SCORES.fieldNames()
    assert [(f.name, f.dataType) for f in done.scores.schema] == [(f.name, f.dataType) for f in schemas.SCORES]


def test_fused_and_literal_metrics_agree(spark, stored):
    from literal import NAMES, literal_metrics

    from haulscore.plans import survey_counts

    frame = settle(survey_counts(stored, SETTINGS), "counts")
    plain, fused = by_key(literal_metrics(frame)), by_key(sample_metrics(frame).select("Reference", *NAMES))
    assert plain.keys() == fused.keys() and plain
    for haul in plain:
        assert plain[haul] == pytest.approx(fused[haul])


def test_settled_tables_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(runtime, "shared_folder", lambda _: str(tmp_path))
    frame = settle(spark.range(3), "cleared")
    folder = Path(frame.inputFiles()[0].removeprefix("file:").replace("//", "/")).parent
    assert folder.exists()
    runtime.clear_settled(spark)
    assert not folder.exists()
