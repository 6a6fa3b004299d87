"""Source mixing against plain Python."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm import mixing
from tests.llm.cases import awkward, empty, frame, prose


def corpus(sizes, words=12):
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((i, prose(i, words + k % 5), None, source, 0))
            i += 1
    return rows


def drawn(spark, rows, target, **more):
    docs = frame(spark, rows).repartition(3)
    planned = mixing.plan(docs, target, **more)
    return {r.source: r for r in planned.collect()}, mixing.mix(docs, planned).collect()


def tokens(rows):
    out = Counter()
    for r in rows:
        out[r[3]] += len((r[1] or "").split())
    return out


def literal_weights(t, a):
    z = sum(x**a for x in t.values())
    return {s: x**a / z for s, x in t.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def test_exponent_meets_the_entropy(spark):
    rows = corpus({"a": 300, "b": 60, "c": 20, None: 40})
    planned, _ = drawn(spark, rows, mixing.Target(entropy=0.9, most_repeats=100))
    t = tokens(rows)
    a = planned["a"].exponent
    assert 0 < a < 1 and entropy(literal_weights(t, a)) == pytest.approx(0.9 * math.log(4), abs=1e-6)
    for s, w in literal_weights(t, a).items():
        assert planned[s].weight == pytest.approx(w, abs=1e-9) and planned[s].budget == pytest.approx(w * sum(t.values()), abs=1)


def test_half_of_the_way_to_even_weights(spark):
    """A target of the corpus's own: sources that are nearly even are mixed as well."""
    rows = corpus({"a": 40, "b": 30, "c": 36})
    planned, out = drawn(spark, rows, mixing.Target(entropy=0.9, closer=0.5, most_repeats=4.0))
    t, most = tokens(rows), math.log(3)
    own = entropy(literal_weights(t, 1.0)) / most
    a = planned["a"].exponent
    assert own > 0.9 and 0 < a < 1
    assert entropy(literal_weights(t, a)) / most == pytest.approx((1 + own) / 2, abs=1e-6) == planned["a"].entropy
    spent = Counter()
    for r in out:
        spent[r.source] += len(r.text.split())
    assert all(abs(spent[s] - p.budget) < 40 for s, p in planned.items()) and max(r.epoch for r in out) == 1
    fixed, _ = drawn(spark, rows, mixing.Target(entropy=None, closer=0.0))
    assert fixed["a"].exponent == 1.0


def test_repetition_limit_raises_the_exponent(spark):
    rows = corpus({"a": 400, "b": 10})
    planned, out = drawn(spark, rows, mixing.Target(entropy=1.0, most_repeats=2.0))
    t = tokens(rows)
    a = planned["a"].exponent
    assert literal_weights(t, a)["b"] * sum(t.values()) / t["b"] == pytest.approx(2.0, abs=1e-4)
    assert max(Counter(r.doc_id for r in out if r.source == "b").values()) <= 2


@pytest.mark.parametrize("block_docs", [7, 1024])
@pytest.mark.parametrize("budget", [0.37, 1.0, 2.6])
def test_budgets_are_met_by_permuted_epochs(spark, block_docs, budget):
    rows = corpus({"a": 200, "b": 50, "c": 11})
    target = mixing.Target(entropy=0.97, most_repeats=6.0, budget=budget)
    planned, out = drawn(spark, rows, target, block_docs=block_docs)
    length = {r[0]: len(r[1].split()) for r in rows}
    by = defaultdict(list)
    for r in out:
        by[r.source, r.epoch].append(r)
    for s, p in planned.items():
        spent = sum(length[r.doc_id] for r in out if r.source == s)
        assert p.budget - max(length.values()) < spent <= p.budget
        everything = {r[0] for r in rows if r[3] == s}
        for e in range(p.epochs):
            assert {r.doc_id for r in by[s, e]} == everything and len(by[s, e]) == len(everything)
        # The last epoch is a prefix of its permutation: the next document would not fit.
        order = sorted(by[s, p.epochs], key=lambda r: (r.block_key, r.block, r.doc_key))
        assert len({r.doc_id for r in order}) == len(order)
        blocks = [r.block for r in order]
        assert blocks == sorted(blocks, key=blocks.index)


def test_even_sources_are_not_sharpened(spark):
    rows = corpus({"a": 30, "b": 33, "c": 36})
    planned, out = drawn(spark, rows, mixing.Target(entropy=0.95, most_repeats=4.0))
    t = tokens(rows)
    assert planned["a"].exponent == 1.0 and Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert planned["a"].entropy == pytest.approx(entropy(literal_weights(t, 1.0)) / math.log(3), abs=1e-9) and planned["a"].entropy > 0.95


def test_entropy_reached_is_told_where_the_repeats_hold_it_down(spark):
    rows = corpus({"a": 200, "b": 3})
    planned, _ = drawn(spark, rows, mixing.Target(entropy=0.95, most_repeats=2.0))
    assert planned["a"].entropy == pytest.approx(entropy({s: p.weight for s, p in planned.items()}) / math.log(2), abs=1e-9) and planned["a"].entropy < 0.5


def numbered(lengths):
    """Documents of (source, words)."""
    return [(i, " ".join(f"w{i}" for _ in range(n)), None, s, 0) for i, (s, n) in enumerate(lengths)]


def test_sources_of_one_and_two_documents_stay(spark):
    rows = numbered([(f"one{i}", 5 + i) for i in range(12)] + [(f"two{i // 2}", 10) for i in range(12)] + [("big", 20)] * 60)
    _, out = drawn(spark, rows, mixing.Target(entropy=None, most_repeats=1.0, budget=0.9))
    assert {r.doc_id for r in out} >= {r[0] for r in rows if r[3] != "big"}
    assert max(Counter(r.doc_id for r in out).values()) == 1
    # The weight of these is worth less than a token of their documents.
    _, out = drawn(spark, rows, mixing.Target(entropy=None, most_repeats=1.0, budget=0.001))
    assert {r.source for r in out} == {r[3] for r in rows}
    assert mixing.plan(frame(spark, rows), mixing.Target(budget=0.0)).where("budget > 0").isEmpty()


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("long", "budget"), [(20_000, 0.02), (3_000, 0.74)])
def test_a_very_long_document_takes_none_along(spark, long, budget, seed):
    rows = numbered([("a", long)] + [("a", 10)] * 100)
    docs = frame(spark, rows)
    planned = mixing.plan(docs, mixing.Target(entropy=None, most_repeats=1.0, budget=budget), seed=seed)
    out, target = mixing.mix(docs, planned, seed=seed).collect(), planned.first().budget
    spent = sum(len(r.text.split()) for r in out)
    # Half the longest document that can come closer.
    assert out and abs(spent - target) <= max(10, long / 2 if long < 2 * target else 0, target / 16)


def test_same_draw_whatever_the_partitions(spark):
    rows = corpus({"a": 90, "b": 30})
    docs = frame(spark, rows)
    target = mixing.Target(entropy=0.99, most_repeats=3.0)
    draws = [sorted(map(tuple, mixing.mix(d, mixing.plan(d, target)).collect())) for d in (docs.coalesce(1), docs.repartition(7))]
    assert draws[0] == draws[1]


def test_exponent_that_may_not_sharpen(spark):
    rows = corpus({"a": 40, "b": 40, "c": 41})
    planned, out = drawn(spark, rows, mixing.Target(entropy=0.5, most_repeats=1.0, budget=0.9, highest_exponent=1.0))
    assert planned["a"].exponent == 1.0 and max(Counter(r.doc_id for r in out).values()) == 1


def test_word_count(spark):
    texts = [None, "", " \t", "a", " a  b\n", "a\x0bb\x0cc\rd"]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", mixing.token_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in sorted(got)] == [len((t or "").encode().split()) for t in texts]


def test_awkward_documents(spark):
    rows = awkward()
    planned, out = drawn(spark, rows, mixing.Target(entropy=None, most_repeats=1.0))
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert planned[None].tokens == 0 and planned[None].weight == 0
    clash = frame(spark, rows).withColumnRenamed("lang", "block")
    got = mixing.mix(clash, mixing.plan(clash, mixing.Target(entropy=None, most_repeats=1.0)))
    assert got.columns == ["doc_id", "text", "source", "n_chars", "block", "epoch", "block_key", "doc_key"] and got.count() == len(rows)


def test_empty_table(spark):
    docs = empty(spark)
    assert mixing.mix(docs, mixing.plan(docs, mixing.Target())).count() == 0
