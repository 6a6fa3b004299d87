"""The pipeline against a plain reading of its stages."""

import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from llm import simhash
from llm.common import settle
from llm.oracle import ORACLE
from llm.queries import QUERIES
from tests.llm.cases import awkward, empty, frame, prose
from tests.llm.test_packing import check
from tests.llm.test_repeats import literal
from tests.llm.test_simhash import literal_components, literal_fingerprint, near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered_names():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash", "suffix_dedup", "mixing", "packing"]


def test_stages_do_what_they_say(spark):
    rows = [(i, prose(i, 150) + (" " + prose(999, 60) if i % 5 == 0 else ""), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[1][1] + " x", "en", "s0", 1), (102, "123 456", "en", "s0", 1), (103, None, None, None, None)]
    steps = dict(corpus_pipeline.STAGES)
    docs = frame(spark, rows)
    known = settle(steps["language_id"](spark, docs, ""), "t")
    assert known.columns == COLUMNS
    assert {r.doc_id for r in known.collect()} == {r[0] for r in rows} - {102, 103}

    single = settle(steps["simhash"](spark, known, ""), "t")
    prints = {r[0]: literal_fingerprint(r[1]) for r in rows if r[0] not in (102, 103)}
    groups = literal_components(sorted(set(prints.values())), near)
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(i, least.get(groups[p], i))
    assert {r.doc_id for r in single.collect()} == set(least.values()) and 100 not in least.values()

    cut = {r.doc_id: r for r in settle(steps["suffix_dedup"](spark, single, ""), "t").collect()}
    texts = [(r.doc_id, r.text) for r in single.collect()]
    want = literal(texts, 100)
    for i, t in texts:
        n, removed, _, _ = want[i, t]
        assert len(cut[i].text.encode()) >= n - removed - 6 and (removed > 0) == (cut[i].text != t)
    assert any(want[i, t][1] for i, t in texts)

    left = spark.createDataFrame(list(cut.values()), docs.schema)
    mixed = steps["mixing"](spark, left, "")
    assert mixed.columns == COLUMNS
    kept = [r.doc_id for r in mixed.collect()]
    assert len(kept) == len(set(kept)) and set(kept) <= set(cut) and len(kept) > 0.7 * len(cut)

    packed = steps["packing"](spark, mixed, "").collect()
    assert {r.doc_id for r in packed} == set(kept)
    check(packed, 1024)


def test_mixing_cuts_nothing_from_even_sources(spark):
    rows = [(i, prose(i, 20 + i % 7), "en", f"s{i % 20}", 1) for i in range(400)]
    mixed = corpus_pipeline.mix_sources(spark, frame(spark, rows), "").collect()
    assert sorted(r.doc_id for r in mixed) == [r[0] for r in rows]


def test_mixing_flattens_a_hot_source_without_losing_small_ones(spark):
    rows = [(i, prose(i, 20), "en", "hot" if i < 500 else f"s{i % 5}", 1) for i in range(600)]
    mixed = corpus_pipeline.mix_sources(spark, frame(spark, rows), "").collect()
    times = Counter(r.doc_id for r in mixed)
    assert set(times) >= {r[0] for r in rows if r[3] != "hot"} and max(times.values()) <= 4
    assert len(mixed) == pytest.approx(len(rows), rel=0.02)
    assert sum(r.source == "hot" for r in mixed) / len(mixed) < 0.6 < 500 / 600


def test_run_is_its_stages(spark, tmp_path):
    frame(spark, awkward() + [(100 + i, prose(i, 80), "en", "s", 1) for i in range(20)]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, str(tmp_path)), name)
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_nothing_to_keep(spark, rows):
    docs = frame(spark, rows) if rows else empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_nothing_outside_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("haulscore/**/*.py"), *root.glob("checks/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        assert not re.search(r"^\s*(from|import) (llm|corpus_pipeline)\b", path.read_text(), re.M), path


def test_operators_keep_to_lineage_that_survives():
    for path in Path(simhash.__file__).parent.glob("*.py"):
        assert "localCheckpoint" not in path.read_text() and "crossJoin" not in path.read_text()
