"""Spelling variants against comparison of all words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from llm import variants
from llm.queries import op12_spelling_variants
from tests.llm.cases import awkward, empty, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal_counts(rows, typos=True, shortest=7, least=2):
    """rows: (doc_id, text)."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if typos and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def literal(counts):
    near = {w: [x for x in counts if x != w and are_near(w, x)] for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * counts[word] else None
    out = set()
    for word, form in forms.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        out.add((word, form, root, counts[word], len(near[word]), None if form is None else counts[form]))
    return out


def found(got):
    rows = [tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def misspelt(seed, n):
    """Documents of a few words, much misspelt, some of runs of equal letters."""
    rng = random.Random(seed)
    base = ["aaaabbbb", "wordlike", "éléphant", "mississippi", "aaaaaaa", "straßen", "notation", "notations"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            word = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abßÿ÷") + word[at:], word[:at] + rng.choice("ab") + word[at + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", ", ", "1"]).join(words)))
    return rows


def test_near_words_forms_and_roots(spark):
    rows = misspelt(1, 150)
    docs = frame(spark, [(i, text, "en", "a", 1) for i, text in rows])
    want = literal(literal_counts(rows))
    assert found(variants.variants(docs, change=variants.without_a_letter)) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_every_pair_once(spark):
    counts = literal_counts(misspelt(2, 60), typos=False)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [(frozenset((r.a, r.b)), r.edit) for r in variants.near_pairs(words).collect()]
    want = {frozenset((a, b)) for a in counts for b in counts if a < b and are_near(a, b)}
    assert len(got) == len(want) and {pair for pair, _ in got} == want
    assert all((edit == "replaced") == (len({len(w) for w in pair}) == 1) for pair, edit in got)


def test_forms_are_followed_through_chains(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(18)] + [("x", "y")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i:02d}": "w18" for i in range(18)} | {"x": "y"}
    assert variants.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_groups_span_batches(spark, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    counts = literal_counts(misspelt(3, 20), typos=False)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in variants.best_near(words).collect()}
    want = {}
    for word in counts:
        others = [x for x in counts if x != word and are_near(word, x)]
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            want[word] = (len(others), best, counts[best])
    assert got == want


def test_partial_counts_of_a_task_add_up(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 5)
    monkeypatch.setattr(variants, "PIECE", 40)
    rows = misspelt(4, 30)
    docs = frame(spark, [(i, text, "en", "a", 1) for i, text in rows])
    got = {r.word: r.n for r in variants.count_words(docs, change=variants.without_a_letter).collect()}
    assert got == literal_counts(rows)


def test_long_text_is_read_in_pieces_at_ends_of_words():
    text = "Wordlike éléphant×÷ x1straßen " * 2000 + "z" * 3000
    assert variants.runs_of(text.encode(), piece=100) == variants.runs_of(text.encode())
    assert variants.runs_of(text.encode()) == {"wordlike": 2000, "éléphant×÷": 2000, "xstraßen"[1:]: 2000, "z" * 3000: 1}


@pytest.mark.parametrize("times", [1, 12])
def test_awkward_documents(spark, times):
    rows = awkward() * times
    docs = frame(spark, rows).selectExpr("*", "'x' AS word", "1 AS n", "'y' AS key", "0 AS root")
    assert found(variants.variants(docs, change=variants.without_a_letter)) == literal(literal_counts([r[:2] for r in rows]))


def test_empty_table(spark):
    assert variants.variants(empty(spark)).count() == 0


def test_query(spark, tmp_path):
    rows = [(i, text, "en", "a", 1) for i, text in misspelt(5, 40)] + [(99, prose(9, 400), "de", "b", 1)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert found(op12_spelling_variants(spark, str(tmp_path))) == literal(literal_counts([r[:2] for r in rows]))
