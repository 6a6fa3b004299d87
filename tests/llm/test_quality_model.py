"""The subword classifier: features, held-out accuracy, awkward documents."""

import tracemalloc
import zlib

import numpy as np
import pytest

from llm import quality_model
from llm.queries import op2_quality_classifier
from tests.llm.cases import awkward, empty, frame, prose


def literal_count(text):
    """Words, neighbouring pairs, and n-grams inside words with their edges."""
    words = text.encode().split()
    grams = sum(max(0, len(w) + 2 - n + 1) for w in words for n in quality_model.GRAMS)
    return len(words) + max(0, len(words) - 1) + grams


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


@pytest.mark.parametrize("text", ["", " ", "a", "ab", "ab cd", " ab\n\ncd ef ", "üß é", prose(1, 50)])
def test_every_feature_is_counted_once(text):
    owner, bucket = quality_model.features(*packed([text]))
    assert len(owner) == len(bucket) == literal_count(text)


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["first text", "", "the second one", "x"]
    owner, bucket = quality_model.features(*packed(texts))
    for i, text in enumerate(texts):
        alone = quality_model.features(*packed([text]))[1]
        assert sorted(bucket[owner == i]) == sorted(alone)


def test_a_repeated_word_is_one_feature():
    a, b = (set(quality_model.features(*packed([t]))[1]) for t in ("foo foo", "quux quux"))
    assert len(a & b) == 1


def junk(i):
    return [f"{prose(i, 40).upper()}!!", " ".join(["same"] * 60), " ".join(f"{w}###" for w in prose(i, 40).split())][i % 3]


def test_held_out_accuracy(spark, tmp_path):
    rows = [(i, prose(i, 60) if i % 4 else junk(i), None, None, None) for i in range(400)] + [(900, None, None, None, None), (901, "", None, None, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op2_quality_classifier(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in held) for i in range(400))
    assert np.mean([got[i].predicted == (i % 4 > 0) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert got[900].score == got[901].score


def test_labels_of_held_out_documents_teach_nothing(spark, tmp_path):
    rows = [(i, prose(i, 30) if i % 2 else junk(i), None, None, None) for i in range(60)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = []
    for flip in (0, 1):
        labels = [(i, int(i % 2) ^ (flip if zlib.crc32(str(i).encode()) % 5 == 0 else 0), 0) for i in range(60)]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        found.append({tuple(r) for r in op2_quality_classifier(spark, str(tmp_path)).collect()})
    assert found[0] == found[1]


def test_awkward_documents_and_labels(spark):
    docs = frame(spark, awkward()).withColumnRenamed("n_chars", "score")
    labels = spark.createDataFrame([(5, 1), (5, 0), (4, 1), (None, 0), (8, None), (2, 0)], "doc_id long, quality int")
    texts, known, share = quality_model.training_sample(docs, labels)
    assert sorted(known) == [0, 1] and share == 0.5
    got = quality_model.score_texts(docs, quality_model.fit(texts, known, share)).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    texts, known, share = quality_model.training_sample(empty(spark), none)
    model = quality_model.fit(texts, known, share)
    assert quality_model.score_texts(empty(spark), model).count() == 0
    assert [r.score for r in quality_model.score_texts(frame(spark, awkward()[:1]), model).collect()] == [pytest.approx(0.5, abs=0.4)]


@pytest.mark.parametrize("text", ["ab cd  ef\n" * 300, "x" * 900 + " ab " + "é" * 700 + " y", " \t ", "a", "one two " + "z" * 5000, "z" * 130 + " " + "q" * 128, "w" * 64 + " v" * 64])
def test_long_texts_in_pieces_have_the_features_of_whole_ones(monkeypatch, text):
    data = np.frombuffer(text.encode(), np.uint8)
    weight = np.random.default_rng(1).normal(size=1 << quality_model.BUCKET_BITS).astype(np.float32)
    bucket = quality_model.features(data, np.array([0, len(data)]))[1]
    for chunk in (16, 64, 1000):
        monkeypatch.setattr(quality_model, "CHUNK", chunk)
        total, count = quality_model.long_sums(weight, data)
        assert count == len(bucket) and total == pytest.approx(float(weight[bucket].sum(dtype=np.float64)), abs=1e-6)


@pytest.mark.parametrize("unit", ["some words of a text ", "unbroken"])
def test_memory_does_not_grow_with_a_text(unit):
    model = quality_model.Model(np.zeros(1 << quality_model.BUCKET_BITS, np.float32), 0.0)
    data = np.frombuffer((unit * (32_000_000 // len(unit))).encode(), np.uint8)
    tracemalloc.start()
    quality_model.scores(model, data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
