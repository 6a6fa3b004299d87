"""Source divergence audit: how far the word shares of each source lie from those of the other sources of its language.

Terms are maximal runs of letters and of characters above ASCII, lower-cased for A-Z only. A language keeps the terms that stand in at least
``least_docs`` of its documents (V of them). A group is a (language, source) that occurs, with or without terms. With N the group's
occurrences of kept terms, a term counted c times has the whole-number share p = 1 + floor(SCALE * (c + 1) / (N + V)), so a term that a group
lacks has a share as well. The distance of p from q is floor((p - q)^2 / q). All arithmetic is in whole numbers.

``pair`` rows hold the sum of the distances of all kept terms, the group's p against another source's q; ``term`` rows hold the terms that
a group uses more than its language does, the ``top`` largest distances of each group.

Method. The sums are a product of the groups' rows with the term-major index (term -> its sources and counts), worked out row by row as
Gustavson did for sparse matrices: a group scatters its terms, through the index, into a dense accumulator with a cell for each peer. No
(group, peer, term) row is ever written. Cells start from the baseline of terms that neither side has. What a group's own terms change against
peers without them, and a peer's terms against a group without them, comes from counts of equal shares; terms that both have are scattered
with these two corrections taken back.

Distribution. The index is cut into blocks of terms by hash, so no block grows with one source or one language; each block carries the totals
of all groups and yields a dense row for each group, and the rows are summed. A block has about ``CHUNK`` postings, so the rows to be summed are as many as
the result's for each ``CHUNK`` postings, and do not grow with the session's partitions. Inside a block, at most ``CHUNK`` postings are worked on at once.
A task holds the totals of one language's groups (a few numbers for each) and never its terms.

Null text, language and source count as empty. Rows that repeat count as often as they stand there. Texts of any length are read in pieces. An empty
table gives an empty table; a language without kept terms has pairs of value 0. Columns other than the three named are not read. Ranks are unique:
equal values follow the bytes of their items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import settle, slices, text_bytes

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200
# Distinct (group, term) counts a task holds before it hands them on, postings worked on at once, cells of a table of shares against peers,
# and bytes of text read at once.
HELD = 200_000
CHUNK = 1 << 18
CELLS = 1 << 20
PIECE = 1 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^A-Za-z\x80-\xff]")
# A count and the documents it comes from, in one number.
_DOC = 1 << 40

COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = T.StructType([T.StructField(name, T.StringType()) for name in ("lang", "source", "part", "item")] + [T.StructField("value", T.LongType())])


def terms_of(raw: bytes, piece: int = PIECE) -> Counter:
    """The terms of a text in UTF-8, counted. ``bytes.lower`` knows exactly A-Z."""
    found: Counter = Counter()
    begin = 0
    while begin < len(raw):
        end = len(raw)
        if begin + piece < end:
            gap = _BETWEEN.search(raw, begin + piece)
            end = gap.end() if gap else end
        found.update(_TERM.findall(raw[begin:end].lower()))
        begin = end
    return found


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed as far as a task can hold them.

    When a task holds too many, the rare ones leave and the frequent half stays to the end, so a frequent term leaves each task as a row a source.
    """
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    size = 0

    def hand_on(last: bool = False) -> Iterator[pa.RecordBatch]:
        nonlocal size
        counted = {group: np.fromiter(terms.values(), np.int64, len(terms)) for group, terms in held.items()}
        docs = np.sort(np.concatenate([values // _DOC for values in counted.values()] or [np.zeros(0, np.int64)]))
        # Terms of more documents than the middle one stay.
        limit = docs[-1] if last and len(docs) else docs[len(docs) // 2] if len(docs) else 0
        size = 0
        for group, values in counted.items():
            terms, leaves = held[group], values // _DOC <= limit
            names = pa.array(list(compress(terms, leaves)), pa.binary()).cast(pa.string())
            held[group] = dict(compress(terms.items(), ~leaves))
            size += len(held[group])
            gone = values[leaves]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(group[0], len(gone)), pa.repeat(group[1], len(gone)), names, pa.array(gone % _DOC), pa.array(gone // _DOC)],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        langs, sources = batch.column("lang"), batch.column("source")
        _, starts = text_bytes(batch.column("text"))
        for first, last in slices(starts, PIECE):
            data, at = text_bytes(batch.column("text").slice(first, last - first))
            raw = data.tobytes()
            for i in range(last - first):
                terms = held.setdefault((langs[first + i].as_py(), sources[first + i].as_py()), {})
                before, known = len(terms), terms.get
                for term, n in terms_of(raw[at[i] : at[i + 1]]).items():
                    terms[term] = known(term, 0) + n + _DOC
                size += len(terms) - before
            if size > HELD:
                yield from hand_on()
    yield from hand_on(last=True)


def term_index(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """The term-major index: (lang, term, source, n, in_lang, leads) of kept terms; ``leads`` marks one row of each term."""
    slim = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in (("lang", lang), ("source", source), ("text", text))))
    # Summed in the tasks already: one shuffle by term then serves the sums, the window and the index.
    dealt = slim.mapInArrow(_term_counts, COUNTS).repartition("lang", "term")
    counted = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # One order for all three, so that one sort serves them.
    in_order = Window.partitionBy("lang", "term").orderBy("source")
    of_term = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.select(
        "lang",
        "term",
        "source",
        "n",
        F.sum("n").over(of_term).alias("in_lang"),
        F.sum("docs").over(of_term).alias("in_docs"),
        (F.row_number().over(in_order) == 1).alias("leads"),
    ).where(F.col("in_docs") >= least_docs).drop("in_docs")


def group_totals(docs: DataFrame, index: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, total, lang_total, kept) of every group that occurs, also of those without terms."""
    groups = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    own = index.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = index.where("leads").groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count("*").alias("kept"))
    return groups.join(own, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "lang_total", "kept"])


def share(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)), digit by digit to base 1000, so that no product leaves 64 bits."""
    divisor = np.maximum(np.asarray(total, np.int64) + kept, 1)
    rest = np.asarray(count, np.int64) + 1
    whole = rest // divisor
    rest = rest - whole * divisor
    for _ in range(3):
        rest = rest * 1000
        digit = rest // divisor
        whole, rest = whole * 1000 + digit, rest - digit * divisor
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _equal_shares(owner: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, share, how often) of the different shares of each owner, owners in order."""
    order = np.lexsort([p, owner])
    owner, p = owner[order], p[order]
    edge = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (p[1:] != p[:-1])])) if len(p) else np.zeros(0, np.int64)
    return owner[edge], p[edge], np.diff(np.append(edge, len(p)))


def accumulate(term: np.ndarray, peer: np.ndarray, n: np.ndarray, in_lang: np.ndarray, totals: np.ndarray, lang_total: int, kept: int, top: int):
    """For each group its dense row of sums against all peers, over these terms, and its ``top`` own terms as (posting, distance).

    Postings come sorted by term, which counts from 0 without gaps; ``totals`` has a number for each peer.
    """
    peers, terms = len(totals), int(term[-1]) + 1 if len(term) else 0
    p, lacking = share(n, totals[peer], kept), share(np.zeros(peers, np.int64), totals, kept)
    q_lang = share(in_lang, lang_total, kept)
    begins = np.searchsorted(term, np.arange(terms + 1))
    by_group = np.argsort(peer, kind="stable")
    group_begins = np.searchsorted(peer[by_group], np.arange(peers + 1))
    h_peer, h_share, h_times = _equal_shares(peer, p)
    h_begins = np.searchsorted(h_peer, np.arange(peers + 1))
    for g in range(peers):
        rows = by_group[group_begins[g] : group_begins[g + 1]]
        nothing = distance(lacking[g], lacking)
        cells = terms * nothing
        # The group's terms against peers without them.
        own, times = h_share[h_begins[g] : h_begins[g + 1]], h_times[h_begins[g] : h_begins[g + 1]]
        step = max(1, CELLS // peers)
        for at in range(0, len(own), step):
            cells = cells + ((distance(own[at : at + step, None], lacking[None, :]) - nothing) * times[at : at + step, None]).sum(0)
        # Peers' terms against the group without them.
        np.add.at(cells, h_peer, h_times * (distance(lacking[g], h_share) - nothing[h_peer]))
        # Terms of both: the group's row runs through the index.
        lengths = begins[term[rows] + 1] - begins[term[rows]]
        mine = np.repeat(rows, lengths)
        theirs = np.arange(len(mine)) + np.repeat(begins[term[rows]] - (np.cumsum(lengths) - lengths), lengths)
        at = peer[theirs]
        both = distance(p[mine], p[theirs]) - distance(p[mine], lacking[at]) - distance(lacking[g], p[theirs]) + nothing[at]
        np.add.at(cells, at, both)
        above = rows[p[rows] > q_lang[rows]]
        far = distance(p[above], q_lang[above])
        first = np.argsort(-far, kind="stable")[:top]
        yield cells, above[first], far[first]


def _scatter(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, language, kind (totals first) and term; a language's postings are worked on at most CHUNK and a term at once."""
    at, totals, held = None, [], []

    def work(postings: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lang = at
        known = pa.Table.from_batches(totals)
        sources = known.column("source").to_pylist()
        sums = known.column("n").to_numpy()
        if not postings and block:
            return
        rows = pa.Table.from_batches(postings or totals[:0], totals[0].schema).combine_chunks()
        names = rows.column("term").combine_chunks()
        new = np.concatenate([[0], pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)]).astype(np.int64) if len(names) else np.zeros(0, np.int64)
        peer = pc.index_in(rows.column("source"), pa.array(sources)).to_numpy().astype(np.int64)
        found = accumulate(
            np.cumsum(new), peer, rows.column("n").to_numpy(), rows.column("aux").to_numpy(), sums, known.column("aux")[0].as_py(), known.column("kept")[0].as_py(), top
        )
        for g, (cells, own, far) in enumerate(found):
            others = np.flatnonzero(np.arange(len(sources)) != g)
            items = pa.concat_arrays([pa.array([sources[i] for i in others], pa.string()), names.take(pa.array(own)).cast(pa.string())])
            parts = pa.concat_arrays([pa.repeat("pair", len(others)), pa.repeat("term", len(own))])
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(items)), pa.repeat(sources[g], len(items)), parts, items, pa.array(np.concatenate([cells[others], far]))], names=PARTS.names
            )

    for batch in batches:
        if not len(batch):
            continue
        blocks, langs = batch.column("block"), batch.column("lang")
        changed = pc.or_(pc.not_equal(blocks[1:], blocks[:-1]), pc.not_equal(langs[1:], langs[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(batch)]
        for first, last in zip(edges, edges[1:], strict=False):
            here = (blocks[first].as_py(), langs[first].as_py())
            if here != at:
                if at is not None:
                    yield from work(held)
                at, totals, held = here, [], []
            part = batch.slice(first, last - first)
            heads = int(pc.sum(pc.equal(part.column("kind"), 0)).as_py())
            if heads:
                totals.append(part.slice(0, heads))
            if heads < len(part):
                held.append(part.slice(heads))
            if sum(map(len, held)) > CHUNK:
                rows = pa.Table.from_batches(held).combine_chunks()
                names = rows.column("term")
                last_term = pc.equal(names, names[-1]).to_numpy()
                cut = len(rows) - int(last_term.sum())
                if cut:
                    yield from work(rows.slice(0, cut).to_batches())
                    held = rows.slice(cut).to_batches()
    if at is not None:
        yield from work(held)


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP, blocks: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) as the module says.

    ``blocks``: how many blocks of terms, by default one for every ``CHUNK`` postings, but not more than the session's shuffle partitions.
    """
    spark = docs.sparkSession
    index = settle(term_index(docs, lang, source, text, least_docs), "term-index")
    count = blocks or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-index.count() // CHUNK)))
    totals = settle(group_totals(docs, index, lang, source), "group-totals")
    heads = totals.select(
        F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"), "lang", F.lit(0).alias("kind"), F.lit("").alias("term"), "source", F.col("total").alias("n"), F.col("lang_total").alias("aux"), "kept"
    )
    postings = index.select(
        F.pmod(F.xxhash64("term"), F.lit(count)).cast("int").alias("block"), "lang", F.lit(1).alias("kind"), "term", "source", "n", F.col("in_lang").alias("aux"), F.lit(0).cast("long").alias("kept")
    )
    # By number, so that each block has a task of its own.
    dealt = heads.unionByName(postings).repartitionById(count, "block").sortWithinPartitions("block", "lang", "kind", "term", "source")
    parts = settle(dealt.mapInArrow(lambda batches: _scatter(batches, top), PARTS), "divergence-parts")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = parts.where("part = 'term'")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
