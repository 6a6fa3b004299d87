"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of variable order, up to ``ORDER``. A context predicts the next byte from
its counts; bytes it has not seen cost an escape and are predicted by the next shorter context, with the seen ones excluded
(escape method C), down to equal chances for all 256 bytes. The counts are frozen after training, so a text's code length under
a language is exact: the sum of its bytes' costs, each under the longest known context before it. The language of
the shortest code wins.

The trees of all languages are laid over one another: one walk finds the context node, and one row there holds each
language's cost of the byte. All bytes of a batch walk at once.

Training texts are drawn from those of at most ``LONGEST_TRAINING_TEXT`` bytes, so a language that has only longer ones is not learned. Texts of any
length are scored whole, in pieces. An empty table stays empty.

Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing could be learned. Ties go to
the language that sorts first. Repeated rows are scored alike; other columns stay; columns that clash with
the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import text_bytes, with_arrow

ORDER = 4
# Bounds of the training sample: texts of each language, and bytes of a text (longer ones are not drawn).
TEXTS_PER_LANGUAGE = 200
LONGEST_TRAINING_TEXT = 65_536
# Context nodes kept. Of two contexts the one stays that makes up more of some language's own training text, so that neither many
# languages nor much text in others crowds a language out; a context occurs at least twice.
MAX_NODES = 12_000
# Bytes that walk at once.
CHUNK = 1 << 18
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray  # byte -> class; class 0 holds the bytes never seen in training
    child: np.ndarray  # node, class -> the node of the context one byte longer, or -1
    cost: np.ndarray  # node * classes + class, language -> bits
    order: int


def _contexts(data: np.ndarray, starts: np.ndarray, classes: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte with ``depth`` bytes before it in its text: its place, and those bytes as a number, nearest first."""
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    at = np.flatnonzero(place >= depth)
    key = np.zeros(len(at), np.int64)
    for back in range(depth, 0, -1):
        key = key * classes + data[at - back]
    return at, key


def fit(texts: Sequence[tuple[str, str]], order: int = ORDER, max_nodes: int = MAX_NODES) -> Model | None:
    """Freeze the trees of (language, text) pairs; None if there are none."""
    languages = sorted({language for language, _ in texts})
    if not languages:
        return None
    raw = {name: [text.lower().encode() for language, text in texts if language == name] for name in languages}
    seen = np.unique(np.frombuffer(b"".join(b"".join(x) for x in raw.values()), np.uint8))
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    classes = len(seen) + 1
    data, starts = [], []
    for name in languages:
        data.append(symbol[np.frombuffer(b"".join(raw[name]), np.uint8)])
        starts.append(np.concatenate([[0], np.cumsum([len(x) for x in raw[name]])]).astype(np.int64))

    # Nodes, level by level: contexts seen often enough whose shorter form is a node as well.
    keys, first, total = [np.zeros(1, np.int64)], [0], 1
    for depth in range(1, order + 1):
        found = [_contexts(x, s, classes, depth)[1] for x, s in zip(data, starts, strict=True)]
        key, of, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        weight, at = np.zeros(len(key)), 0
        for one in found:
            weight = np.maximum(weight, np.bincount(of[at : at + len(one)], minlength=len(key)) / max(len(one), 1))
            at += len(one)
        kept = (count >= 2) & np.isin(key % classes ** (depth - 1), keys[-1])
        key, weight = key[kept], weight[kept]
        room = (max_nodes - total) // (2 if depth < order else 1)
        if len(key) > room:
            key = np.sort(key[np.argsort(-weight, kind="stable")[:room]])
        keys.append(key)
        first.append(total)
        total += len(key)
    child = np.full((total, classes), -1, np.int32)
    for depth in range(1, order + 1):
        above = first[depth - 1] + np.searchsorted(keys[depth - 1], keys[depth] % classes ** (depth - 1))
        child[above, keys[depth] // classes ** (depth - 1)] = first[depth] + np.arange(len(keys[depth]))

    width = np.ones(classes)
    width[0] = 256 - len(seen)
    cost = np.empty((total, classes, len(languages)), np.float32)
    for j, (x, s) in enumerate(zip(data, starts, strict=True)):
        above = np.full((1, classes), 1 / 256)
        for depth in range(order + 1):
            at, key = _contexts(x, s, classes, depth)
            node = np.searchsorted(keys[depth], key)
            node[node == len(keys[depth])] = 0
            hit = keys[depth][node] == key if len(keys[depth]) else np.zeros(len(key), bool)
            size = len(keys[depth])
            count = np.bincount(node[hit] * classes + x[at[hit]], minlength=size * classes).reshape(size, classes).astype(float)
            if depth:
                above = level[np.searchsorted(keys[depth - 1], keys[depth] % classes ** (depth - 1))]  # noqa: F821
            n, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
            left = np.where(count > 0, 0, above * width).sum(1, keepdims=True)
            escape = np.where(left > 0, kinds / np.maximum(n + kinds, 1), 0)
            shorter = escape * above / np.where(left > 0, left, 1)
            level = np.where(n == 0, above, np.where(count > 0, count / np.maximum(n + np.where(left > 0, kinds, 0), 1), shorter))
            cost[first[depth] : first[depth] + size, :, j] = -np.log2(np.maximum(level, 1e-300))
    return Model(languages, symbol, child, cost.reshape(total * classes, len(languages)), order)


def code_lengths(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bits of each text under each language. Long texts are walked in pieces that see the bytes before them."""
    classes = model.child.shape[1]
    child = model.child.reshape(-1)
    symbols = model.symbol[data]
    bits = np.zeros((len(starts) - 1, len(model.languages)))
    for begin in range(0, len(data), CHUNK):
        end = min(begin + CHUNK, len(data))
        first, last = np.searchsorted(starts, begin, side="right") - 1, np.searchsorted(starts, end, side="left")
        edges = np.maximum(starts[first:last], begin)
        rows = np.arange(first, last)
        rows, edges = rows[starts[first + 1 : last + 1] > edges], edges[starts[first + 1 : last + 1] > edges]
        lengths = np.diff(np.append(edges, end))
        place = np.arange(begin, end) - np.repeat(starts[rows], lengths)
        node = np.zeros(end - begin, np.int32)
        alive = np.ones(end - begin, bool)
        for back in range(1, model.order + 1):
            before = symbols[np.maximum(np.arange(begin - back, end - back), 0)]
            longer = child[node * classes + before]
            alive &= (longer >= 0) & (place >= back)
            node = np.where(alive, longer, node)
        cost = model.cost[node * classes + symbols[begin:end]]
        bits[rows] += np.add.reduceat(cost, edges - begin, axis=0, dtype=np.float64)
    return bits


def training_sample(
    docs: DataFrame, text: str = "text", language: str = "lang", per_language: int = TEXTS_PER_LANGUAGE, longest: int = LONGEST_TRAINING_TEXT
) -> list[tuple[str, str]]:
    """A bounded sample of different labelled texts, drawn by a hash of the text: at most ``per_language`` of each language.

    Copies of a text count once, so that they take no places from others.
    """
    labelled = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull() & (F.octet_length(text) <= longest)).select(
        F.col(language).alias("l"), F.col(text).alias("t"), F.xxhash64(text).alias("h")
    )
    different = labelled.select("l", "h").distinct()
    counts = {row["l"]: row["n"] for row in different.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    # Draw about four times the wanted number before ranking, so that no language gathers all its rows in one task.
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("l") == name, min(1.0, 4 * per_language / n)).otherwise(share)
    drawn = labelled.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).groupBy("l", "h").agg(F.min("t").alias("t"))
    ranked = drawn.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", "t")))
    return [(row["l"], row["t"]) for row in ranked.where(F.col("k") <= per_language).select("l", "t").collect()]


def identify(docs: DataFrame, model: Model | None, text: str = "text", prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add ``prediction``, ``score`` (the chance of the language given equal ones before) and ``bits_per_byte``."""
    added = [prediction, score, "bits_per_byte"]
    docs = docs.drop(*added)
    if model is None:
        return docs.withColumn(prediction, F.lit(UNDETERMINED)).withColumn(score, F.lit(0.0)).withColumn("bits_per_byte", F.lit(None).cast("double"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    fields = [T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]

    def walk(part: pa.RecordBatch) -> list[pa.Array]:
        frozen = Model(**shared.value)
        names = np.array(frozen.languages, dtype=object)
        data, starts = text_bytes(pc.utf8_lower(part.column(text)))
        bits = code_lengths(frozen, data, starts)
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        chance = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
        known = part.column("_lettered").to_numpy(zero_copy_only=False)
        lengths = np.diff(starts)
        return [
            pa.array(np.where(known, names[best], UNDETERMINED), pa.string()),
            pa.array(np.where(known, chance, 0.0)),
            pa.array(least / np.maximum(lengths, 1), mask=lengths == 0),
        ]

    lettered = docs.withColumn("_lettered", F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))
    return with_arrow(lettered, text, fields, walk, drop=["_lettered"])
