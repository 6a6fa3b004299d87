"""SimHash near-duplicates against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm import simhash
from llm.common import components
from tests.llm.cases import awkward, empty, frame, prose

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def literal_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def near(a, b):
    return (a ^ b).bit_count() <= 3


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one two", "One TWO three four", "a\x0bb\x0cc\rd é É", prose(5, 400)])
def test_fingerprint_is_the_literal_one(text):
    assert simhash.fingerprint_of((text or "").encode()) == literal_fingerprint(text)


def test_masks_meet_every_pair_within_three_bits():
    rng = random.Random(1)
    masks = simhash.first_masks()
    assert len(masks) == 20
    for _ in range(200):
        varying = sum(1 << i for i in rng.sample(range(64), rng.randint(4, 40)))
        a, free = rng.getrandbits(64), [i for i in range(64) if varying >> i & 1]
        b = a ^ sum(1 << i for i in rng.sample(free, 3))
        assert any(a & f == b & f for f in simhash.finer_masks(varying))
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), 3))
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("most", [simhash.MOST_IN_GROUP, 4])
def test_links_connect_what_brute_force_connects(spark, most):
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        here = rng.getrandbits(64)
        for _ in range(18):  # chains: each step flips up to four bits
            prints.add(here)
            here ^= sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4)))
    base = rng.getrandbits(64)
    prints |= {base ^ (1 << i) ^ (1 << j) for i in range(8) for j in range(8)}  # one dense group
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    docs = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = simhash.links(docs, most=most)
    rows = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all(near(a, b) for a, b in rows)
    found = {r.node: r.component for r in components(edges, "t").collect()}
    want = literal_components(sorted(prints), near)
    groups = Counter(want.values())
    got = Counter(found.get(p, p) for p in signed)
    assert sorted(groups.values()) == sorted(got.values())


def test_links_of_a_dense_group_are_linear_and_masks_come_from_the_data(spark):
    """All fingerprints that differ in nine free bits, split far below their number."""
    base = 0x9E3779B97F4A7C15
    places = [0, 7, 13, 22, 31, 40, 44, 52, 63]
    prints = [base ^ sum(1 << p for i, p in enumerate(places) if k >> i & 1) for k in range(512)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), most=64)
    assert edges.count() <= 40 * len(prints)
    found = components(edges, "t").collect()
    assert len(found) == 512 and {r.component for r in found} == {min(signed)}


def test_a_pair_is_linked_where_it_shares_no_earlier_mask():
    group = np.array([0, 1, 2, 4 << 40], np.uint64).view(np.int64)
    assert len(simhash.spanning_links(group)) == 3
    assert simhash.spanning_links(group, earlier=[0xFF]) == [(0, 1), (0, 2), (2, 4 << 40)]
    # Only pairs that differ under both masks are left.
    assert simhash.spanning_links(group, earlier=[0xFF, 0xFF << 40]) == [(1, 4 << 40), (4 << 40, 2)]


def test_components_of_chain_star_and_pairs(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-5, 7000), (7000, -5), (3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "t").collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {7000: -5, -5: -5}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_awkward_documents(spark):
    rows = awkward()
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = [literal_fingerprint(r[1]) for r in rows]
    want = literal_components(sorted(set(prints)), near)
    ids = {}
    for r, p in zip(rows, prints, strict=True):
        ids.setdefault(want[p], []).append(r[0])
    least = {c: min((i for i in x if i is not None), default=None) for c, x in ids.items()}
    expected = Counter((r[0], p, least[want[p]]) for r, p in zip(rows, prints, strict=True))
    assert Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got) == expected
    kept = simhash.keep_first(frame(spark, rows).withColumnRenamed("n_chars", "fingerprint")).collect()
    assert len(kept) == len(least)
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "fingerprint"]


def test_a_long_text_is_read_whole():
    text = prose(6, 90_000)
    assert simhash.fingerprint_of(text.encode()) == literal_fingerprint(text)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(empty(spark)).count() == 0


def test_spanning_links_stay_linear():
    group = np.array([1 << i for i in range(60)], np.uint64).view(np.int64)
    assert len(simhash.spanning_links(group)) == 59
