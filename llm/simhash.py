"""SimHash near-duplicates by pigeonhole blocks.

A document's fingerprint has a bit for each bit place that more than half of its shingle hashes set. Two documents link if their
fingerprints differ in at most ``DISTANCE`` bits. A fingerprint is split into six blocks: two that differ in three bits agree on three of the blocks,
so pairs meet by one of the twenty choices of three blocks and are then verified bit by bit.

Equal fingerprints are one node from the start, however many documents share them. A group larger than ``MOST_IN_GROUP`` fingerprints is split
on: the bits that vary in it are cut into four parts, one of which a linked pair must share, and so on until every group is small; a group
in which at most ten bits vary cannot be larger. Finer masks are worked out from each large group's bits, in tasks.

A pair may meet in several groups but belongs to one: under the first mask that it shares, and in a split group the first part. A group returns the
links of a spanning forest of the pairs that belong to it, never all pairs.

Null and empty texts have fingerprint zero and link like any other. Rows that repeat an id and a text are one document; rows that
repeat only the id are told apart by their text. A null id never names a component unless all ids in it are null. An empty table gives an empty table.
A text of any length is one row's work: its words are held, its hashes counted in pieces. Other columns pass through ``keep_first``; a column named like an
added one is replaced in ``with_fingerprint`` and not read elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from haulscore.runtime import lookup_join
from llm.common import components, settle, text_bytes, with_arrow

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
MOST_IN_GROUP = 1024
# Shingle hashes whose bits are counted at once.
HASHES = 1 << 16

EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def fingerprint_of(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text in UTF-8. ``bytes.lower`` and ``bytes.split`` know exactly A-Z and the six ASCII blanks."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - shingle_words + 1)
    counts = np.zeros(64, np.int64)
    for begin in range(0, n, HASHES):
        here = [b" ".join(tokens[i : i + shingle_words]) for i in range(begin, min(n, begin + HASHES))]
        hashes = np.fromiter(map(xxh64_intdigest, here, repeat(seed)), np.uint64, len(here))
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle_words: int = SHINGLE_WORDS, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add the fingerprint as a long (the 64 bits as a signed number)."""

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        data, starts = text_bytes(part.column(text))
        raw = data.tobytes()
        found = [fingerprint_of(raw[a:b], shingle_words) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        return [pa.array(np.array(found, np.uint64).view(np.int64))]

    return with_arrow(docs, text, [T.StructField(out, T.LongType())], run, drop=drop)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def first_masks(bits: tuple[int, ...] = BLOCK_BITS, distance: int = DISTANCE) -> list[int]:
    """The bits of every choice of blocks that leaves ``distance`` blocks out."""
    blocks, at = [], 0
    for width in bits:
        blocks.append(((1 << width) - 1) << at)
        at += width
    return [sum(chosen) for chosen in combinations(blocks, len(blocks) - distance)]


def finer_masks(varying: int, distance: int = DISTANCE) -> list[int]:
    """Masks of all bits but the varying ones, with one of ``distance + 1`` parts of these."""
    parts = np.array_split([i for i in range(64) if varying >> i & 1], distance + 1)
    rest = ~varying & ((1 << 64) - 1)
    return [rest | sum(1 << int(i) for i in part) for part in parts]


def spanning_links(group: np.ndarray, distance: int = DISTANCE, earlier: Sequence[int] = ()) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints at most ``distance`` bits apart that share none of the ``earlier`` masks."""
    links, rest = [], group.view(np.uint64)
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            here = frontier.pop()
            differ = rest ^ here
            near = np.bitwise_count(differ) <= distance
            if near.any():
                for mask in earlier:
                    near &= (differ & np.uint64(mask)) != 0
                found = rest[near]
                links += [(int(here), int(other)) for other in found]
                frontier += list(found)
                rest = rest[~near]
    return links


def _spanning(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for group, earlier in zip(batch.column("group"), batch.column("earlier").to_pylist(), strict=True):
            found += spanning_links(group.values.to_numpy(), distance, [mask % (1 << 64) for mask in earlier])
        ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


FINER = "family long, mask long, key long, part int, finer long, earlier array<long>"


def _split(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """The finer masks of large groups, each with all masks that come before it."""
    for batch in batches:
        rows = []
        for family, mask, key, varying, earlier in zip(*(batch.column(c).to_pylist() for c in ("family", "mask", "key", "varying", "earlier")), strict=True):
            masks = [_signed(m) for m in finer_masks(varying % (1 << 64), distance)]
            rows += [(family, mask, key, i, finer, earlier + masks[:i]) for i, finer in enumerate(masks)]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["family", "mask", "key", "part", "finer", "earlier"])


def links(fingerprints: DataFrame, column: str = "fingerprint", distance: int = DISTANCE, most: int = MOST_IN_GROUP) -> DataFrame:
    """(a, b) links between different fingerprints that connect exactly what lies within ``distance`` bits, step by step."""
    first = [_signed(mask) for mask in first_masks(distance=distance)]
    coarse = F.array(*[F.struct(F.lit(i).cast("long").alias("family"), F.lit(mask).alias("mask")) for i, mask in enumerate(first)])
    rows = fingerprints.select(F.col(column).alias("f")).distinct().select("f", F.explode(coarse).alias("m")).select("f", "m.*")
    # A family is what one mask of one split group holds; it knows the masks before its own.
    listed = F.array(*[F.struct(F.lit(i).cast("long").alias("family"), F.array(*[F.lit(m) for m in first[:i]]).cast("array<long>").alias("earlier")) for i in range(len(first))])
    families = settle(fingerprints.sparkSession.range(1).select(F.explode(listed).alias("m")).select("m.*"), "simhash-families")
    out = None
    group = ["family", "mask", "key"]
    while True:
        keyed = rows.withColumn("key", F.col("f").bitwiseAND(F.col("mask")))
        varying = F.bit_or("f").bitwiseAND(F.bitwise_not(F.bit_and("f")))
        sizes = settle(keyed.groupBy(*group).agg(F.count("*").alias("n"), varying.alias("varying")).where("n > 1"), "simhash-groups")
        # All pairs of a group with so few varying bits are linked.
        is_large = (F.col("n") > most) & (F.bit_count("varying") > distance)
        small = keyed.join(sizes.where(~is_large), group).groupBy(*group).agg(F.collect_list("f").alias("group"))
        found = lookup_join(small, families, ["family"], "inner").select("group", "earlier").mapInArrow(lambda batches: _spanning(batches, distance), EDGES)
        found = settle(found, "simhash-edges")
        out = found if out is None else out.union(found)
        large = sizes.where(is_large)
        if large.isEmpty():
            return out
        finer = settle(lookup_join(large, families, ["family"], "inner").mapInArrow(lambda batches: _split(batches, distance), FINER), "simhash-finer")
        finer = finer.withColumn("next", F.xxhash64(*group, "part"))
        rows = settle(keyed.join(finer.drop("earlier"), group).select("f", F.col("next").alias("family"), F.col("finer").alias("mask")), "simhash-large")
        families = finer.select(F.col("next").alias("family"), "earlier")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per document: key, ``text_hash``, ``fingerprint``, ``component_id`` and ``stays`` (one document of each component)."""
    slim = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("_text"))
    marked = settle(with_fingerprint(slim, "_text", "fingerprint", shingle_words, drop=("_text",)), "fingerprints")
    found = components(links(marked, distance=distance), "simhash")
    order = F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("id"), F.col("text_hash").alias("h"))
    nodes = marked.groupBy("fingerprint").agg(F.min(order).alias("first"))
    nodes = nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("c"))
    least = nodes.groupBy("c").agg(F.min("first").alias("least"))
    named = settle(nodes.join(least, "c").select("fingerprint", "least"), "simhash-components")
    return marked.join(named, "fingerprint").select(
        key, "text_hash", "fingerprint", F.col("least.id").alias("component_id"), (order == F.col("least")).alias("stays")
    )


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest key.

    Texts are shuffled once, to meet the keys that stay. Only rows that repeat both id and text, if there are any, are compared with one another.
    """
    found = near_duplicates(docs, key, text, shingle_words, distance).where("stays").groupBy(F.col(key).alias("_key"), F.col("text_hash").alias("_text_hash"))
    stay = settle(found.agg(F.count("*").alias("_rows")), "simhash-stay")
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    single, repeated = stay.where("_rows = 1"), stay.where("_rows > 1")
    same = hashed[key].eqNullSafe(single["_key"]) & (hashed["_text_hash"] == single["_text_hash"])
    kept = hashed.join(single, same, "left_semi").drop("_text_hash")
    if repeated.isEmpty():
        return kept
    rows = lookup_join(hashed, repeated.select(F.col("_key").alias(key), "_text_hash", "_rows"), [key, "_text_hash"], "inner", null_safe=True)
    return kept.unionByName(rows.drop("_rows").dropDuplicates([key, "_text_hash"]).drop("_text_hash"))
