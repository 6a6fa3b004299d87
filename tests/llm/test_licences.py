"""Licence scans against plain Python."""

import re

import pytest

from llm import licences
from llm.queries import op9_licence_scan
from tests.llm.cases import awkward, empty, frame, prose


def literal(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    places = [(i, label) for phrase, label in licences.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


TEXTS = [
    None, "", "...", "Under the MIT License", "x under  the,mit-license! y", "under the mit licenses", "sunder the mit license",
    "CC BY-NC 4.0 cc by nc by nc, cc-by-nc", "Apache License, Version 2.0 and under the MIT\nlicense", "éunder the mit license",
    "apache license version 2 apache license version 2", "under the mit under the mit license", "İ under the mit license 日本 cc by nc",
    prose(1, 200) + " apache-license-version-2 " + prose(2, 100),
]


def test_base_places_are_the_literal_ones(spark, tmp_path):
    frame(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op9_licence_scan(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == literal(TEXTS[r.doc_id]), TEXTS[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1.0 if r.n_base else True)


@pytest.mark.parametrize(
    ("expression", "named", "demanded"),
    [
        ("mit", {"mit"}, "mit"),
        ("mit or apache-2.0", {"mit", "apache-2"}, "apache-2 or mit"),
        ("mit and apache-2.0 and mit", {"mit", "apache-2"}, "apache-2 and mit"),
        ("mit and (bsd-3-clause or gpl-2.0+)", {"mit", "bsd-3-clause", "gpl-2.0+"}, "(bsd-3-clause or gpl-2.0+) and mit"),
        ("gpl-2.0 with classpath-exception-2.0 or mit", {"gpl-2.0-with-classpath-exception-2.0", "mit"}, "gpl-2.0-with-classpath-exception-2.0 or mit"),
        ("a or b and c", {"a", "b", "c"}, "(b and c) or a"),
        ("(a or b) and c", {"a", "b", "c"}, "(a or b) and c"),
        ("c and (b or (a or b))", {"a", "b", "c"}, "(a or b) and c"),
        ("(a or a) and a", {"a"}, "a"),
        ("mit. this file is free", {"mit"}, "mit"),
        ("mit */", {"mit"}, "mit"),
        ("mit or", {"mit"}, "mit"),
        ("((mit", {"mit"}, "mit"),
        (") mit", set(), ""),
        ("", set(), ""),
        ("or mit", set(), ""),
    ],
)
def test_expressions(expression, named, demanded):
    tree = licences.parse(expression)
    assert licences.licences(tree) == named
    assert licences.demands(tree) == demanded


def test_and_and_or_differ_in_a_row(spark):
    texts = ["SPDX-License-Identifier: MIT AND Apache-2.0", "spdx-license-identifier: apache-2.0 or mit", "SPDX-License-Identifier: A\nprose\nSPDX-License-Identifier: B OR C", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.demands) for r in licences.scan(docs).collect()}
    assert got == {0: ("apache-2,mit", "apache-2 and mit"), 1: ("apache-2,mit", "apache-2 or mit"), 2: ("a,b,c", "a; b or c"), 3: ("", "")}


def test_many_hits_and_long_expressions_take_time_in_proportion():
    machine = licences.automaton(licences.BASE_PHRASES, licences.MORE_PHRASES)
    text = "x " + "under the MIT license, cc by-nc; " * 100_000
    n, base, first, last, marked, *_ = licences.scan_text(text, machine)
    assert (n, base, first, last, marked) == (700_001, 200_000, 1, 700_001 - 3, "cc-by-nc,mit")
    for joint, depth in ((" and ", "(" * 50_000), (" or ", "")):
        tagged = "SPDX-License-Identifier: " + depth + joint.join(f"l{i}" for i in range(20_000))
        got = licences.scan_text(tagged, machine)
        assert got[5].count(",") == 19_999 and got[7].count(joint) == 19_999


def test_binding():
    tree = licences.parse("a or b and c with d")
    assert (tree.name, tree.right.name, tree.right.right.name) == ("or", "and", "with")


def test_tags_add_labels():
    machine = licences.automaton(licences.BASE_PHRASES, licences.MORE_PHRASES)
    text = "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nprose under the MIT license"
    assert licences.scan_text(text, machine)[4:] == ("mit", "apache-2,bsd-3-clause,mit", 1.0, "(apache-2 or mit) and bsd-3-clause")
    assert licences.scan_text("GNU General Public License, version 3", machine)[5:] == ("gpl,gpl-3", 0.9, "")


def test_awkward_documents(spark):
    rows = awkward()
    got = licences.scan(frame(spark, rows).withColumnRenamed("source", "labels")).collect()
    assert len(got) == len(rows)
    assert got[0].__fields__[:4] == ["doc_id", "text", "lang", "n_chars"]
    assert licences.scan(empty(spark)).count() == 0
