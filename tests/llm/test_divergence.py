"""Source divergence against plain Python numbers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm import divergence
from llm.queries import op11_source_divergence
from tests.llm.cases import awkward, empty, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal(rows, least_docs=3, top=200):
    """rows: (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        peers = sorted(s for one, s in groups if one == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = shares(counts[lang, source])
        q = shares(sum((counts[lang, s] for s in peers), Counter()))
        pairs = []
        for other in peers:
            if other != source:
                r = shares(counts[lang, other])
                pairs.append((other, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)))
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked) if part == "pair" or i < top}
    return out


def found(frame_):
    rows = [tuple(r) for r in frame_.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def some_documents():
    rows = []
    for i in range(120):
        source = f"s{i % 7}" if i % 3 else "hot"
        rows.append((i, prose(i % 40, 5 + i % 60) + (" Éa only" + source) * (i % 4), "xy"[i % 2], source, 1))
    rows.append((500, "1 2 3", "bare", "a", 1))
    rows.append((501, None, "bare", "b", 1))
    rows.append((502, "alone", "alone", "a", 1))
    return rows


@pytest.mark.parametrize("blocks,chunk", [(3, 1 << 18), (1, 50), (5, 7)])
def test_values_and_ranks(spark, monkeypatch, blocks, chunk):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "CELLS", 16)
    rows = some_documents()
    got = found(divergence.divergence(frame(spark, rows), blocks=blocks, top=9))
    assert got == literal([r[1:4] for r in rows], top=9)
    assert ("bare", "a", "pair", "b", 0, 1) in got
    assert not [r for r in got if r[0] == "alone"]


def test_partial_rows_do_not_grow_with_the_partitions(spark, monkeypatch, conf):
    """A row for each group and peer, and the terms of each group, for each block; few postings are one block, in however many partitions the session shuffles."""
    conf("spark.sql.shuffle.partitions", "40")
    written = {}
    plain = divergence.settle

    def seen(frame_, name):
        written[name] = plain(frame_, name)
        return written[name]

    monkeypatch.setattr(divergence, "settle", seen)
    rows = some_documents()
    got = found(divergence.divergence(frame(spark, rows)))
    assert got == literal([r[1:4] for r in rows])
    assert written["divergence-parts"].count() == len(got)
    # More postings are more blocks, each in a task of its own, up to the session's partitions.
    monkeypatch.setattr(divergence, "CHUNK", 100)
    blocks = -(-written["term-index"].count() // 100)
    assert 2 <= blocks <= 40
    assert found(divergence.divergence(frame(spark, rows))) == got
    assert len(written["divergence-parts"].inputFiles()) <= blocks


def test_partial_counts_of_a_task_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 20)
    monkeypatch.setattr(divergence, "PIECE", 64)
    rows = some_documents()
    assert found(divergence.divergence(frame(spark, rows), blocks=2)) == literal([r[1:4] for r in rows])


def test_awkward_documents(spark):
    rows = awkward() * 3
    docs = frame(spark, rows).selectExpr("*", "1 AS value", "2 AS rank", "'x' AS item", "0 AS block")
    assert found(divergence.divergence(docs)) == literal([r[1:4] for r in rows])


def test_empty_table(spark):
    got = divergence.divergence(empty(spark))
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_long_text_is_read_in_pieces_at_ends_of_terms():
    text = ("Word été日本 x1y " * 3000 + "z" * 5000).encode()
    whole = divergence.terms_of(text)
    assert divergence.terms_of(text, piece=100) == whole
    assert whole[b"word"] == 3000 and whole["été日本".encode()] == 3000 and whole[b"z" * 5000] == 1


def test_shares_are_exact_beyond_64_bits():
    counts = [0, 1, 7, 10**12, 10**15 - 1]
    got = divergence.share(np.array(counts), np.array(10**15), 12345)
    assert got.tolist() == [1 + 10**9 * (c + 1) // (10**15 + 12345) for c in counts]


def test_query_reads_null_fields_as_empty(spark, tmp_path):
    rows = some_documents() + [(600 + i, prose(i, 30), None, None if i % 2 else "s1", 1) for i in range(9)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert found(op11_source_divergence(spark, str(tmp_path))) == literal([r[1:4] for r in rows])
