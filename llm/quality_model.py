"""A quality classifier of supervised subword embeddings.

Words, pairs of neighbouring words, and character n-grams inside words are hashed into buckets, each with a learned vector. A
document is the mean of its features' vectors; a softmax over two classes reads it. Vectors and softmax are
trained together by stochastic gradient descent in numpy on a bounded sample of labelled texts.

The softmax of a mean of vectors needs of each bucket only its two class scores, so scoring a text is one look-up per feature.
Null and empty texts have no features and get the score of the mean document, the share of label 1. Texts of any length are read in pieces. A text's score depends on nothing but its words.
Repeated rows are scored alike; other columns stay; a column that clashes with the added ones is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import text_bytes, with_arrow

# Hash buckets (a power of two), vector length, character n-gram lengths.
BUCKET_BITS = 18
DIMENSIONS = 16
GRAMS = (3, 4, 5)
EPOCHS = 6
RATE = 0.7
# Bounds of the training sample: texts of each label, and bytes of a text (longer ones are not drawn).
TEXTS_PER_LABEL = 1_500
LONGEST_TRAINING_TEXT = 65_536
# Bytes that are hashed at once.
CHUNK = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[:1], down[:1] = 1, 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = h * _MIX
    return ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every feature of the texts."""
    n = len(starts) - 1
    # Each text gets a blank before it, and all white space becomes a blank: a word's edge shows in its n-grams.
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
    padded = np.full(len(data) + n + 1, 0x20, np.uint8)
    padded[np.arange(len(data)) + text + 1] = np.where(_BLANK[data], 0x20, data)
    owner = np.zeros(len(padded), np.int32)
    owner[1:] = np.repeat(np.arange(n + 1, dtype=np.int32), np.append(np.diff(starts) + 1, 0))
    blank = padded == 0x20
    before = np.cumsum(blank, dtype=np.int32)
    wide = padded.astype(np.uint64)
    out = []
    for size in GRAMS:
        if len(padded) < size:
            continue
        last = len(padded) - size + 1
        h = np.full(last, np.uint64(size))
        for j in range(size):
            h = h * _BASE + wide[j : j + last]
        inside = np.flatnonzero(before[size - 2 : size - 2 + last] == before[:last])
        out.append((owner[inside + 1], _bucket(h[inside])))
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(edges) % 2:
        edges = np.append(edges, len(padded))
    begin, end = edges[::2], edges[1::2]
    if len(begin):
        up, down = _powers(len(padded))
        total = np.concatenate([[np.uint64(0)], np.cumsum(wide * up, dtype=np.uint64)])
        word = (total[end] - total[begin]) * down[begin]
        out.append((owner[begin], _bucket(word)))
        pair = np.flatnonzero(owner[begin[1:]] == owner[begin[:-1]])
        # A pair is hashed by its words' difference: a word that follows itself is one feature, whatever the word.
        out.append((owner[begin[pair]], _bucket(word[pair + 1] - word[pair] + np.uint64(1))))
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


@dataclass
class Model:
    weight: np.ndarray  # each bucket's log-odds for label 1, before the mean
    bias: float


def fit(texts: Sequence[str], labels: Sequence[int], share: float | None = None, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> Model:
    """Train on texts with labels 0 and 1. ``share`` is label 1's share outside the sample, if the sample is another.

    Without texts every score is 0.5; with one label only, the sample's share decides.
    """
    labels = np.asarray(labels, np.int64)
    chance = (labels.sum() + 1) / (len(labels) + 2)
    prior = np.log(chance / (1 - chance))
    wanted = prior if share is None else np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    softmax = rng.uniform(-0.5, 0.5, (2, DIMENSIONS)).astype(np.float32)
    bias = np.array([0.0, prior], np.float32)
    rows = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        bucket, count = np.unique(features(raw, np.array([0, len(raw)]))[1], return_counts=True)
        rows.append((bucket, (count / max(count.sum(), 1)).astype(np.float32)))
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            bucket, share_of = rows[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share_of @ vectors[bucket]
            logit = softmax @ mean + bias
            odds = np.exp(logit - logit.max())
            slope = odds / odds.sum()
            slope[labels[i]] -= 1
            if len(bucket):
                # Shares of unit length: long texts move their vectors as far as short ones.
                vectors[bucket] -= np.outer(share_of / np.sqrt(share_of @ share_of), step * (slope @ softmax))
            softmax -= step * np.outer(slope, mean)
            bias -= step * slope / 10
    side = softmax[1] - softmax[0]
    return Model((vectors @ side).astype(np.float32), float(bias[1] - bias[0] - prior + wanted))


def _hash_of(word: np.ndarray) -> np.uint64:
    """The hash that ``features`` gives a word, in pieces."""
    h, ahead = 0, 1
    for begin in range(0, len(word), CHUNK):
        part = word[begin : begin + CHUNK].astype(np.uint64)
        up, _ = _powers(len(part))
        h = (h + int((part * up).sum(dtype=np.uint64)) * ahead) % (1 << 64)
        ahead = ahead * pow(int(_BASE), len(part), 1 << 64) % (1 << 64)
    return np.uint64(h)


def _gram_sums(weight: np.ndarray, word: np.ndarray) -> tuple[float, int]:
    """Sum of weights and number of the n-grams of one long word."""
    total, count, most = 0.0, 0, max(GRAMS)
    padded = np.concatenate([[0x20], word, [0x20]]).astype(np.uint8)
    for begin in range(0, len(padded), CHUNK):
        wide = padded[begin : begin + CHUNK + most - 1].astype(np.uint64)
        for size in GRAMS:
            last = min(len(wide) - size + 1, CHUNK)
            if last < 1:
                continue
            h = np.full(last, np.uint64(size))
            for j in range(size):
                h = h * _BASE + wide[j : j + last]
            total, count = total + float(weight[_bucket(h)].sum(dtype=np.float64)), count + last
    return total, count


def long_sums(weight: np.ndarray, data: np.ndarray) -> tuple[float, int]:
    """Sum of weights and number of the features of one text, in pieces of about CHUNK bytes cut at white space; a longer word is a piece of its own."""
    total, count, begin, before = 0.0, 0, 0, None
    while begin < len(data):
        end = min(len(data), begin + CHUNK)
        if end < len(data):
            blanks = np.flatnonzero(_BLANK[data[begin:end]])
            if len(blanks) and blanks[-1] > 0:
                end = begin + int(blanks[-1])
            else:
                while end < len(data) and not len(ahead := np.flatnonzero(_BLANK[data[end : end + CHUNK]])):
                    end = min(len(data), end + CHUNK)
                end += int(ahead[0]) if end < len(data) else 0
        piece = data[begin:end]
        blank = np.concatenate([[True], _BLANK[piece], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        begin = end
        if not len(edges):
            continue
        first, last = piece[edges[0] : edges[1]], piece[edges[-2] : edges[-1]]
        if before is not None:  # the pair across the cut
            total, count = total + float(weight[_bucket(np.array([_hash_of(first)]) - np.array([before]) + np.uint64(1))][0]), count + 1
        before = _hash_of(last)
        if len(edges) == 2 and len(piece) > CHUNK:
            grams, n = _gram_sums(weight, first)
            total, count = total + grams + float(weight[_bucket(np.array([before]))][0]), count + n + 1
        else:
            _, bucket = features(piece, np.array([0, len(piece)]))
            total, count = total + float(weight[bucket].sum(dtype=np.float64)), count + len(bucket)
    return total, count


def scores(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The chance of label 1 of each text. A text of more than CHUNK bytes is read in pieces, so memory does not grow with it."""
    n = len(starts) - 1
    if n == 1 and len(data) > CHUNK:
        total, count = (np.array([x]) for x in long_sums(model.weight, data))
    else:
        owner, bucket = features(data, starts)
        total = np.bincount(owner, weights=model.weight[bucket], minlength=n)[:n]
        count = np.bincount(owner, minlength=n)[:n]
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.bias, -30, 30)))


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = TEXTS_PER_LABEL, longest: int = LONGEST_TRAINING_TEXT,
) -> tuple[list[str], list[int], float | None]:
    """Texts and labels of a bounded sample, and label 1's share of all labelled keys.

    Keys are drawn by their hash, ``per_label`` at most for each label, before the texts are looked up, so the table that
    is broadcast has a fixed bound. Keys with both labels, null keys and null texts are left out.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("l"), F.max(label).alias("m")).where("l = m").select(key, "l")
    counts = {row["l"]: row["n"] for row in known.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], [], None
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("l") == name, min(1.0, 4 * per_label / n)).otherwise(share)
    drawn = known.withColumn("h", F.xxhash64(key)).where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20))
    ranked = drawn.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("h", key))).where(F.col("k") <= per_label).select(key, "l")
    wanted = docs.where(F.col(text).isNotNull() & (F.octet_length(text) <= longest)).select(key, text)
    rows = wanted.join(F.broadcast(ranked), key).select(F.col(text).alias("t"), "l").collect()
    rows = sorted((row["t"], int(row["l"])) for row in rows)
    return [t for t, _ in rows], [x for _, x in rows], counts.get(1, 0) / sum(counts.values())


def score_texts(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, the chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(scores(Model(**shared.value), *text_bytes(part.column(text))))]

    return with_arrow(docs, text, [T.StructField(out, T.DoubleType())], run, most=CHUNK)
