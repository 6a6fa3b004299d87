"""Repeated passages by windows matched at minimizers, after the parse of prefix-free parsing.

Every byte covered by a ``width``-byte string that also starts earlier in the corpus is removed. Earlier means a smaller document
id, or an earlier place in the same document.

Parsing. A rolling hash over ``gram`` bytes names triggers: each ``width``-byte string is assigned to the place of its least gram hash (the first of
equal ones). A phrase is a trigger with all strings assigned to it, at most ``2 * width - gram`` bytes. What a string is assigned to
depends on its bytes alone, so equal strings sit at the same place around equal triggers, and each string lies in one phrase.

Parse. Phrases are sorted by trigger, content and corpus order. Every occurrence of a phrase but the first is a repeat as a whole;
the first ones make up the dictionary, which is small for repetitive text.

Dictionary. Only triggers with two or more different phrases can still hold repeats, at the rims of repeated passages. The ``width``-byte windows of
their phrases are sorted, trigger by trigger; equal ones stand side by side in corpus order, and all but the first are repeats. No suffix
array of the dictionary or of the parse is built.

Phrases around one trigger are told apart by 64-bit hashes, their strings byte by byte. Triggers with more than
``MOST_PHRASES`` phrases are not gathered (a gathered one costs a few hundred bytes of a worker); their strings meet by 128-bit hashes, with the least place taken before the shuffle.

Null and empty texts have nothing to remove, nor has a text shorter than ``width``. Rows that repeat an id and a text are one document; rows
that repeat only the id are ordered by a hash of the text. A null id comes first. Texts of any length are parsed in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from llm.common import settle, slices, text_bytes

WIDTH = 100
GRAM = 24
MOST_PHRASES = 50_000
# Bytes parsed at once, and bytes of text whose phrases are compared before the shuffle.
CHUNK = 1 << 18
COMBINE = 8 << 20

_BASE = 0x100000001B3
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(127)

PHRASES = T.StructType([T.StructField(name, T.LongType()) for name in ("route", "g", "x", "doc", "v")] + [T.StructField(name, T.IntegerType()) for name in ("lo", "hi", "at")])
SPANS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("v", T.LongType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, np.uint64(_BASE)), np.full(n, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def phrases(data: np.ndarray, starts: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first string's start, last string's start, trigger's place, gram hash) of every phrase of the texts, in order."""
    reach = width - gram + 1
    if not 0 < gram < width or reach > 128:
        raise ValueError("gram must be less than width, and width - gram less than 128")
    up, down = _powers(CHUNK + width + 1)
    parts, last_owner = [], -1
    for begin in range(0, len(data), CHUNK):
        end = min(len(data), begin + CHUNK)
        piece = data[begin : min(len(data), end + width)].astype(np.uint64)
        grams = len(piece) - gram + 1
        if grams < reach:
            break
        total = np.concatenate([[np.uint64(0)], np.cumsum((piece + np.uint64(1)) * up[: len(piece)], dtype=np.uint64)])
        h = (total[gram:] - total[:-gram]) * down[:grams] * _MIX
        h ^= h >> np.uint64(32)
        h *= _MIX
        # Least hash of `reach` places, by doubling; the low seven bits hold how far ahead it stands.
        least, span = h & ~_LOW, 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:] + np.uint64(span))
            span *= 2
        if span < reach:
            least = np.minimum(least[: -(reach - span)], least[reach - span :] + np.uint64(reach - span))
        n = min(len(least), end - begin)
        first, last = np.searchsorted(starts, begin, side="right") - 1, np.searchsorted(starts, begin + n, side="left")
        stops = np.minimum(starts[first + 1 : last + 1], begin + n) - np.maximum(starts[first:last], begin)
        room = np.repeat(starts[first + 1 : last + 1] - width, np.maximum(stops, 0))
        start = np.flatnonzero(np.arange(begin, begin + n) <= room)
        if not len(start):
            continue
        owner = start + (least[start] & _LOW).astype(np.int64)
        edge = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
        lo, hi = start[edge] + begin, np.append(start[edge[1:] - 1], start[-1]) + begin
        at, g = owner[edge] + begin, h[owner[edge]]
        if at[0] == last_owner:  # the phrase goes on from the piece before
            parts[-1][1][-1] = hi[0]
            lo, hi, at, g = lo[1:], hi[1:], at[1:], g[1:]
        if len(at):
            last_owner = at[-1]
            parts.append([lo, hi, at, g])
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Where a run of adjoining spans of one document begins."""
    return np.concatenate([[True], (row[1:] != row[:-1]) | (lo[1:] != hi[:-1] + 1)]) if len(row) else np.zeros(0, bool)


def _parse(batch: pa.RecordBatch, width: int, gram: int) -> pa.RecordBatch:
    """Phrases of a batch in corpus order; what repeats inside the batch leaves as spans already known (at = -1)."""
    order = np.lexsort([batch.column("v").to_numpy(), batch.column("doc").to_numpy()])
    batch = batch.take(pa.array(order))
    ids, versions = batch.column("doc").to_numpy(), batch.column("v").to_numpy()
    data, starts = text_bytes(batch.column("text"))
    lo, hi, at, g = phrases(data, starts, width, gram)
    row = np.searchsorted(starts, lo, side="right") - 1
    raw = memoryview(data.tobytes())
    x = np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(lo, hi + width, strict=True)), np.uint64, len(lo))
    base = starts[row]
    lo, hi, at = lo - base, hi - base, at - base
    code = pd.factorize(x ^ (g * _MIX))[0] if len(x) else np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(np.maximum.accumulate(np.concatenate([[-1], code]))) > 0)
    earlier = first[code] if len(code) else code
    repeat = earlier != np.arange(len(code))
    same_place = repeat & (ids[row] == ids[row[earlier]]) & (versions[row] == versions[row[earlier]]) & (lo == lo[earlier])
    known = repeat & ~same_place
    new = ~repeat
    # Known repeats that adjoin become one span.
    krow, klo, khi = row[known], lo[known], hi[known]
    begins = np.flatnonzero(_runs(krow, klo, khi))
    ends = np.append(begins[1:], len(krow)) - 1 if len(begins) else begins
    pieces = {
        "g": np.concatenate([g[new].view(np.int64), np.zeros(len(begins), np.int64)]),
        "x": np.concatenate([x[new].view(np.int64), np.zeros(len(begins), np.int64)]),
        "doc": np.concatenate([ids[row[new]], ids[krow[begins]]]),
        "v": np.concatenate([versions[row[new]], versions[krow[begins]]]),
        "lo": np.concatenate([lo[new], klo[begins]]).astype(np.int32),
        "hi": np.concatenate([hi[new], khi[ends]]).astype(np.int32),
        "at": np.concatenate([at[new], np.full(len(begins), -1)]).astype(np.int32),
    }
    # Phrases meet by trigger and content; known spans go anywhere.
    own = np.concatenate([np.ones(new.sum(), bool), np.zeros(len(begins), bool)])
    mixed = (pieces["g"].view(np.uint64) ^ (pieces["x"].view(np.uint64) * _MIX)).view(np.int64)
    route = np.where(own, mixed, (pieces["doc"].view(np.uint64) * _MIX + pieces["lo"].astype(np.uint64)).view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(route), *(pa.array(value) for value in pieces.values())], names=PHRASES.names)


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    column = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(column).alias("v"), column.cast("binary").alias("text"))


def _split_parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of phrases sorted by trigger, content and corpus order: first ones pass with at >= 0, others as spans with at = -1."""
    held = None  # the first occurrence that the batch before ended in
    for batch in batches:
        if not len(batch):
            continue
        g, x, doc, v, lo, at = (batch.column(name).to_numpy() for name in ("g", "x", "doc", "v", "lo", "at"))
        changes = np.concatenate([[True], (g[1:] != g[:-1]) | (x[1:] != x[:-1])]) | (at < 0)
        goes_on = held is not None and at[0] >= 0 and held[0] == g[0] and held[1] == x[0]
        first = np.maximum.accumulate(np.where(changes, np.arange(len(g)), 0))
        fdoc, fv, flo = doc[first], v[first], lo[first]
        new = changes.copy()
        if goes_on:
            until = np.flatnonzero(changes[1:])
            until = until[0] + 1 if len(until) else len(g)
            fdoc[:until], fv[:until], flo[:until] = held[2:]
            new[0] = False
        held = (g[-1], x[-1], fdoc[-1], fv[-1], flo[-1]) if at[-1] >= 0 else None
        same_place = ~new & (doc == fdoc) & (v == fv) & (lo == flo)
        out = np.where(new, at, -1).astype(np.int32)
        columns = [*(batch.column(i) for i in range(len(PHRASES) - 1)), pa.array(out)]
        yield pa.RecordBatch.from_arrays(columns, names=PHRASES.names).filter(pa.array(~same_place))


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The bytes of a document's listed phrases."""
    for batch in batches:
        for doc, v, text, listed in zip(*(batch.column(name) for name in ("doc", "v", "text", "listed")), strict=True):
            raw, rows = text.as_py(), listed.as_py()
            for first in range(0, len(rows), 4096):
                part = rows[first : first + 4096]
                yield pa.RecordBatch.from_pydict(
                    {
                        "g": pa.array([p["g"] for p in part], pa.int64()),
                        "doc": pa.array([doc.as_py()] * len(part), pa.int64()),
                        "v": pa.array([v.as_py()] * len(part), pa.int64()),
                        "lo": pa.array([p["lo"] for p in part], pa.int32()),
                        "at": pa.array([p["at"] for p in part], pa.int32()),
                        "bytes": pa.array([raw[p["lo"] : p["hi"] + width] for p in part], pa.binary()),
                    }
                )


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], names=SPANS.names)


def sorted_suffixes(group: list[tuple], width: int) -> list[tuple]:
    """Spans of the strings of one trigger's phrases, given in corpus order, that an earlier phrase holds as well.

    Equal strings lie at the same place around the trigger, so the strings of one place after another are sorted: at most one of each phrase is held.
    """
    ahead = [at - lo for _, _, lo, at, _ in group]
    repeated = []
    for before in range(max(ahead) + 1):  # bytes of a string before the trigger
        found = [(i, ahead[i] - before) for i, row in enumerate(group) if 0 <= ahead[i] - before <= len(row[-1]) - width]
        strings = [group[i][-1][j : j + width] for i, j in found]
        order = sorted(range(len(strings)), key=strings.__getitem__)  # stable: equal strings stay in corpus order
        repeated += [found[b] for a, b in zip(order, order[1:], strict=False) if strings[a] == strings[b]]
    repeated.sort()
    out = []
    for i, j in repeated:
        doc, v, lo = group[i][:3]
        if out and out[-1][:2] == (doc, v) and out[-1][3] == lo + j - 1:
            out[-1] = (doc, v, out[-1][2], lo + j)
        else:
            out.append((doc, v, lo + j, lo + j))
    return out


def _match(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of each trigger's phrases; rows come sorted by trigger and corpus order."""
    group, trigger = [], None
    for batch in batches:
        found = []
        for g, *row in zip(*(batch.column(name).to_pylist() for name in ("g", "doc", "v", "lo", "at", "bytes")), strict=True):
            if g != trigger and group:
                found += sorted_suffixes(group, width)
                group = []
            trigger = g
            group.append(tuple(row))
        yield _spans(found)
    if group:
        yield _spans(sorted_suffixes(group, width))


def _strings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Every string of the phrases, by hash."""
    for batch in batches:
        for doc, v, lo, content in zip(*(batch.column(name).to_pylist() for name in ("doc", "v", "lo", "bytes")), strict=True):
            n = len(content) - width + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "h": pa.array([xxh3_128_digest(content[j : j + width]) for j in range(n)], pa.binary()),
                    "doc": pa.array([doc] * n, pa.int64()),
                    "v": pa.array([v] * n, pa.int64()),
                    "lo": pa.array(range(lo, lo + n), pa.int32()),
                }
            )


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, most: int = MOST_PHRASES) -> DataFrame:
    """(doc, v, lo, hi): the strings that start at lo to hi of the document are repeats. Spans may overlap."""
    given = _documents(docs, key, text)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, starts = text_bytes(batch.column("text"))
            for first, last in slices(starts, COMBINE):
                yield _parse(batch.slice(first, last - first), width, gram)

    parsed = given.where(F.octet_length("text") >= width).mapInArrow(parse, PHRASES)
    sorted_phrases = parsed.repartition("route").sortWithinPartitions("g", "x", "doc", "v", "lo")
    parse_table = settle(sorted_phrases.mapInArrow(_split_parse, PHRASES).drop("route", "x"), "parse")
    dictionary = parse_table.where("at >= 0")
    triggers = settle(dictionary.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"), "triggers")

    def cut_out(chosen: DataFrame) -> DataFrame:
        # Settled, so that the shuffles of phrases are gone from the disks before texts are shuffled.
        listed = settle(dictionary.join(chosen.select("g"), "g").groupBy("doc", "v").agg(F.collect_list(F.struct("g", "lo", "hi", "at")).alias("listed")), "listed")
        texts = given.dropDuplicates(["doc", "v"]).join(listed, ["doc", "v"])
        return texts.select("doc", "v", "text", "listed").mapInArrow(lambda b: _cut(b, width), "g long, doc long, v long, lo int, at int, bytes binary")

    few = cut_out(triggers.where(F.col("n") <= most)).repartition("g").sortWithinPartitions("g", "doc", "v", "lo")
    spans = parse_table.where("at < 0").select("doc", "v", "lo", "hi").union(settle(few.mapInArrow(lambda b: _match(b, width), SPANS), "rims"))
    many = triggers.where(F.col("n") > most)
    if not many.isEmpty():
        strings = settle(cut_out(many).mapInArrow(lambda b: _strings(b, width), "h binary, doc long, v long, lo int"), "strings")
        place = F.struct("doc", "v", "lo")
        first = strings.groupBy("h").agg(F.min(place).alias("first"))
        spans = spans.union(strings.join(first, "h").where(place > F.col("first")).select("doc", "v", "lo", F.col("lo").alias("hi")))
    return spans


def cover(size: int, lo: np.ndarray, hi: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal runs [begin, end) of the bytes covered by the strings that start at lo to hi."""
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.minimum(np.maximum.accumulate(hi[order] + width), size)
    if not len(lo):
        return []
    begins = np.concatenate([[True], lo[1:] > end[:-1]])
    return list(zip(lo[begins].tolist(), end[np.append(np.flatnonzero(begins)[1:], len(lo)) - 1].tolist(), strict=True))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, most: int = MOST_PHRASES, keep_text: bool = True) -> DataFrame:
    """Add n_bytes, n_removed, n_spans and kept_sha256; with ``keep_text`` the text is what is left of it, else it is dropped.

    What is left is read as UTF-8; parts of characters at the cuts are dropped from the text, not from the hash.
    """
    added = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    docs = docs.drop(*(field.name for field in added), "_spans", "_doc", "_v")
    spans = repeated_spans(docs, key, text, width, gram, most)
    listed = spans.groupBy(F.col("doc").alias("_doc"), F.col("v").alias("_v")).agg(F.collect_list(F.struct("lo", "hi")).alias("_spans"))
    keyed = docs.withColumn("_doc", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))).withColumn("_v", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = keyed.join(listed, ["_doc", "_v"], "left").drop("_doc", "_v")
    kept = [field for field in docs.schema.fields if keep_text or field.name != text]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, last in slices(text_bytes(whole.column(text))[1], COMBINE):
                batch = whole.slice(first, last - first)
                rows, left = [], []
                for value, listed in zip(batch.column(text), batch.column("_spans"), strict=True):
                    raw = (value.as_py() or "").encode()
                    runs = []
                    if listed.is_valid:
                        fields = listed.values
                        runs = cover(len(raw), fields.field("lo").to_numpy(), fields.field("hi").to_numpy(), width)
                    edges = [0, *(x for run in runs for x in run), len(raw)]
                    rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    rows.append((len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
                    if keep_text:
                        left.append(rest.decode(errors="ignore") if value.is_valid else None)
                columns = [pa.array(left, pa.string()) if field.name == text else batch.column(field.name) for field in kept]
                columns += [pa.array([row[i] for row in rows], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
