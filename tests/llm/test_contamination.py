"""Benchmark contamination against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm import contamination
from llm.queries import op13_decontamination
from tests.helpers import plan_of
from tests.llm.cases import awkward, empty, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def literal(docs, items, width=10):
    """One row a document; docs: (id, text), items: (id, text)."""
    windows = set()
    for item, text in items:
        w = words(text)
        windows |= {(tuple(w[i : i + width]), "" if item is None else str(item)) for i in range(max(1, len(w) - width + 1)) if w}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, met = set(), set()
        for window, item in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    met.add(item)
        out.append((doc_id, len(w), len(hit), len(met), tuple(sorted(met)), bool(hit)))
    return Counter(out)


def found(got):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated) for r in got.collect())


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def corpus(seed=1):
    rng = random.Random(seed)
    few = "a b c d e the of".split()  # words so frequent that most windows are made of them
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(20, prose(3, 40)), (21, prose(3, 40)), (22, "Alone"), (23, ""), (24, None), (25, "never seen anywhere, not a word of it here"), (3, prose(8, 12))]
    docs = [(i, " ".join(rng.choice(few) for _ in range(200))) for i in range(30)]
    docs += [(100 + i, prose(i, 30) + " " + " ".join(words(items[12][1])[i : i + 8 + i % 5]) + " " + prose(50 + i, 9)) for i in range(12)]
    docs += [(200, items[12][1].upper()), (201, "x alone, y ALONE"), (202, " ".join(t for _, t in items if t))]
    return docs, items


def test_hits_and_items(spark):
    docs, items = corpus()
    got = found(contamination.contamination(frame(spark, [(*d, "en", "s", 1) for d in docs]), benchmark(spark, items)))
    assert got == literal(docs, items)
    assert sum(row[2] > 0 for row in got) > 10


@pytest.mark.parametrize("width", [1, 2, 3])
def test_short_windows(spark, width):
    docs, items = corpus(2)
    got = found(contamination.contamination(frame(spark, [(*d, "en", "s", 1) for d in docs]), benchmark(spark, items), width=width))
    assert got == literal(docs, items, width)


def test_sides_too_large_to_broadcast_give_the_same(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr("haulscore.runtime.BROADCAST_BYTES", 0)
    got = contamination.contamination(frame(spark, [(*d, "en", "s", 1) for d in docs]), benchmark(spark, items))
    assert found(got) == literal(docs, items)


def test_awkward_documents(spark):
    rows = awkward()
    items = [(1, rows[0][1]), (2, "one"), (None, rows[7][1]), (None, "日本語 テキスト"), (3, prose(1, 30))]
    docs = frame(spark, rows).selectExpr("*", "1 AS `row`", "2 AS pos", "3 AS term", "'x' AS word")
    assert found(contamination.contamination(docs, benchmark(spark, items).withColumn("phrase", F.lit(0)))) == literal([r[:2] for r in rows], items)


def test_empty_tables(spark):
    none = benchmark(spark, [])
    assert contamination.contamination(empty(spark), benchmark(spark, [(1, "one")])).count() == 0
    got = contamination.contamination(frame(spark, awkward()), none)
    assert found(got) == literal([r[:2] for r in awkward()], [])


def test_exact_and_near_matches(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("a b c d e f g h".split()) for _ in range(60))) for i in range(40)] + [(90, "c x a x b"), (91, "a b"), (92, "")]
    phrases = [(0, ["a", "b", "c"]), (1, ["h", "h", "a"]), (2, ["q", "a"]), (3, ["d"]), (4, ["e", "f"])]
    listed = spark.createDataFrame(phrases, "phrase long, words array<string>")
    index = contamination.build_index(frame(spark, [(*d, "en", "s", 1) for d in docs]), listed.select(F.explode("words").alias("word")))
    ids = {r.row: r.doc_id for r in index.documents.collect()}
    got = {(ids[r.row], r.phrase, r.start) for r in contamination.exact_matches(index, listed).collect()}
    texts = {i: t.split() for i, t in docs}
    assert got == {(i, p, at) for i, t in texts.items() for p, w in phrases for at in range(len(t)) if t[at : at + len(w)] == w}

    def literal_near(within):
        counts = Counter(w for t in texts.values() for w in t)
        out = set()
        for i, t in texts.items():
            for p, listed_words in phrases:
                need = set(listed_words)
                if not all(counts[w] for w in need):
                    continue
                rarest = min(need, key=lambda w: (counts[w], list(dict.fromkeys(listed_words)).index(w)))
                for at in (k for k, w in enumerate(t) if w == rarest):
                    held = [(b - a, a, b) for a in range(max(0, at - within + 1), at + 1) for b in range(at, min(len(t), a + within)) if need <= set(t[a : b + 1])]
                    if held:
                        out.add((i, p, at, min(held)[1], min(held)[2]))
        return out

    for within in (3, 5):
        near = {(ids[r.row], r.phrase, r.at, r.first, r.last) for r in contamination.near_matches(index, listed, within).collect()}
        assert near == literal_near(within)


def test_no_python_on_the_way(spark):
    docs, items = corpus()
    got = contamination.contamination(frame(spark, [(*d, "en", "s", 1) for d in docs]), benchmark(spark, items))
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)


def test_query_digest(spark, tmp_path):
    docs, items = corpus(4)
    items = [(i, t) for i, t in items if i != 3] + [(110, "Alone")]  # "110" sorts before "22"
    frame(spark, [(*d, "en", "s", 1) for d in docs]).write.parquet(str(tmp_path / "documents.parquet"))
    benchmark(spark, items).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = Counter(tuple(r) for r in op13_decontamination(spark, str(tmp_path)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())
    want = Counter()
    for (doc_id, n, hit, n_items, ids, is_hit), times in literal(docs, items).items():
        want[doc_id, n, hit, n_items, hashlib.sha256(",".join(ids).encode()).hexdigest(), is_hit] += times
    assert got == want
