"""Repeated passages against a literal reading of the rule."""

import hashlib
import random

import pytest

from llm import repeats
from tests.llm.cases import awkward, empty, frame, prose


def literal(rows, width):
    """doc position -> (n_bytes, n_removed, n_spans, sha256); rows in corpus order, equal (id, text) rows are one document."""
    seen, out = set(), {}
    for id_, text in sorted(set(rows), key=lambda r: (-1 if r[0] is None else r[0])):
        raw = (text or "").encode()
        removed = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            piece = raw[s : s + width]
            if piece in seen:
                removed[s : s + width] = b"\1" * width
            seen.add(piece)
        rest = bytes(b for b, r in zip(raw, removed, strict=True) if not r)
        spans = bytes(removed).count(b"\0\1") + (len(raw) > 0 and removed[0] == 1)
        out[id_, text or ""] = (len(raw), sum(removed), spans, hashlib.sha256(rest).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    shared = [prose(100 + i, rng.randint(8, 60)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(seed * 1000 + i * 10 + k, rng.randint(0, 40)) if rng.random() < 0.5 else rng.choice(shared)[rng.randint(0, 30) :] for k in range(4)]
        rows.append((i, rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1][50:]), (202, "ab" * 400), (203, "ab" * 350 + "c"), (204, "z" * 700), (205, None), (206, "é" * 300)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "width", "gram", "most"), [(1, 100, 24, 50_000), (2, 100, 24, 2), (3, 40, 8, 50_000)])
def test_removes_what_the_rule_removes(spark, seed, width, gram, most):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_bytes int").repartition(5)
    got = repeats.remove_repeats(docs, width=width, gram=gram, most=most).collect()
    want = literal(rows, width)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, texts[r.doc_id] or ""], r.doc_id


def test_long_text_is_parsed_in_pieces(spark, monkeypatch):
    rows = [(1, prose(9, 3000)), (2, prose(8, 500) + prose(9, 3000)[2000:9000])]
    monkeypatch.setattr(repeats, "CHUNK", 1500)
    monkeypatch.setattr(repeats, "COMBINE", 4000)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, texts = literal(rows, 100), dict(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, texts[r.doc_id]] for r in got)


def test_awkward_documents(spark):
    rows = awkward()
    got = repeats.remove_repeats(frame(spark, rows), keep_text=False).collect()
    assert len(got) == len(rows)
    # A repeated row is the same document: neither takes bytes from the other.
    same = [r for r in got if r.doc_id == 5 and r.n_bytes == len(rows[0][1].encode())]
    assert len(same) == 2 and same[0] == same[1] and same[0].n_removed == 0
    later = next(r for r in got if r.doc_id == 8)
    assert later.n_removed == len(rows[0][1].encode()) and later.n_spans == 1
    assert next(r for r in got if r.doc_id == 10).n_removed == 4999
    nulls = [r for r in got if r.n_bytes == 0]
    assert len(nulls) == 3 and all(r.kept_sha256 == hashlib.sha256(b"").hexdigest() for r in nulls)


def test_kept_text_stays_utf8(spark):
    shared = "ü" * 120
    rows = [(1, "a" + shared), (2, "é" + shared[:101] + "z")]
    got = {r.doc_id: r.text for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].startswith("a")
    assert got[2].startswith("é") and got[2].endswith("z")


def test_empty_table(spark):
    out = repeats.remove_repeats(empty(spark))
    assert out.count() == 0
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
