"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Documents are cut into pieces of at most ``capacity`` tokens and placed in bulk-synchronous steps. Documents and gaps are both sorted by
size. As sizes are whole numbers up to the capacity, either order has at most that many runs of equal sizes, and a step
handles a whole run: the longest pieces left look for their successor among the gaps, the smallest gap that takes them; pieces and gaps of the two
runs are matched by rank; the gaps shrink; the next step follows. Where no gap is large enough new sequences are opened. This is
best-fit decreasing over all pieces at once.

The order of the runs needs only the number of pieces of each length, one number for each length, whatever the size of the corpus. Pieces
are ranked where they were tokenized: each task counts its pieces of each length, sums over tasks give each task's first rank, and a look-up in
the list of steps gives a piece its sequence and offset. Texts are never shuffled, and a length that many pieces share is no group.

A null text is empty; an empty text is one end token. Rows that repeat an id are documents of their own. An empty table gives no pieces. The tokenizer is
read from files whose paths are parameters; executors need them at the same paths.
"""

from __future__ import annotations

import base64
import heapq
import json
import sys
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import settle

CAPACITY = 1024
END_ID = 2
# Texts whose UTF-8 bytes all stay at or below this one hold Latin letters at most (up to U+024F).
LATIN = 0xC9

PIECES = [
    T.StructField("part", T.IntegerType()),
    T.StructField("rank", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
]


def default_paths() -> tuple[str, str]:
    """The byte-level BPE of 50k ids, for the tokenizers library and as ranks for tiktoken."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(vocabulary: str, ranks: str | None):
    """The encoder of these files; a Python worker reads them once for all its tasks."""
    kept = sys.modules.setdefault("_encoders_of_worker", ModuleType("_encoders_of_worker"))
    found = vars(kept).setdefault("encoders", {})
    if (vocabulary, ranks) not in found:
        found[vocabulary, ranks] = new_encoder(vocabulary, ranks)
    return found[vocabulary, ranks]


def new_encoder(vocabulary: str, ranks: str | None):
    """A function from text to ids (uint32), as tokenizers gives them without special tokens added.

    With ``ranks``, the same vocabulary as a rank file, Latin texts without the string of a special token go through tiktoken, which gives
    the same ids some four times faster; all others go through tokenizers.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)

    def by_tokenizers(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks is None:
        return by_tokenizers
    import tiktoken
    from public_tokenizers import PATTERN

    with open(vocabulary, encoding="utf-8") as file:
        special = [token["content"] for token in json.load(file).get("added_tokens", [])]
    with open(ranks, "rb") as file:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> np.ndarray:
        raw = text.encode()
        if not raw or max(raw) > LATIN or any(token in text for token in special):
            return by_tokenizers(text)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but the first may be shorter."""
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(at, capacity) for at in range(first, n, capacity)]


def tokenize(docs: DataFrame, text: str = "text", capacity: int = CAPACITY, paths: tuple[str, str | None] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: the other columns, the piece's place and length, a CRC of its ids, the ids on request, and its rank in its task."""
    vocabulary, ranks = paths or default_paths()
    fields = PIECES + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    docs = docs.drop(*(field.name for field in fields))
    others = [field for field in docs.schema.fields if field.name != text]
    schema = T.StructType([*others, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for first in range(0, len(whole), 512):
                batch = whole.slice(first, 512)
                row, out = [], {field.name: [] for field in fields}
                for i, value in enumerate(batch.column(text)):
                    ids = np.append(encode(value.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                    for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                        here = ids[start : start + length]
                        row.append(i)
                        values = [part, seen[length], k, start, length, zlib.crc32(here.tobytes())] + ([here.astype(np.int32)] if with_ids else [])
                        seen[length] += 1
                        for name, x in zip(out, values, strict=True):
                            out[name].append(x)
                taken = batch.take(pa.array(row, pa.int64()))
                kinds = {"part": pa.int32(), "piece": pa.int32(), "ids": pa.list_(pa.int32())}
                columns = [taken.column(field.name) for field in others]
                columns += [pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The steps of the packing, from the number of pieces of each length (index 0 to capacity).

    Each row: length, first rank, number of pieces, first sequence, pieces for each sequence, offset of the first of these.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    open_gaps: list[int] = []  # gaps that have runs, sorted
    steps, opened = [], 0

    def leave(gap: int, first: int, number: int) -> None:
        if not gap or not number:
            return
        if gap not in runs:
            runs[gap] = []
            open_gaps.insert(int(np.searchsorted(open_gaps, gap)), gap)
        heapq.heappush(runs[gap], (first, number))

    for length in range(capacity, 0, -1):
        rank, left = 0, int(counts[length])
        while left:
            at = int(np.searchsorted(open_gaps, length))
            if at < len(open_gaps):
                gap = open_gaps[at]
                first, number = heapq.heappop(runs[gap])
                if not runs[gap]:
                    del runs[gap], open_gaps[at]
            else:
                gap, first = capacity, opened
                number = -(-left // (capacity // length))
                opened += number
            each = gap // length
            full = min(number, left // each)
            if full:
                steps.append((length, rank, full * each, first, each, capacity - gap))
                leave(gap - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < number and left:  # the last sequence of the run takes what is left
                steps.append((length, rank, left, first + full, left, capacity - gap))
                leave(gap - left * length, first + full, 1)
                full, left = full + 1, 0
            leave(gap, first + full, number - full)
    return np.array(steps, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to tokenized pieces, which must be a settled table."""
    spark = pieces.sparkSession
    mine = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = mine.select("part", "length", F.coalesce(before, F.lit(0)).alias("_before"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in mine.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row for each length at most
        counts[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(plan(counts, capacity))
    ranked = pieces.drop("sequence_id", "offset").join(ranks, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("_before")).drop("_before")
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        # Steps come by falling length, then rising rank; a length and a rank as one sort key of two numbers.
        bounds = {int(length): np.searchsorted(-steps[:, 0], [-length, -length + 1]) for length in np.unique(steps[:, 0])}
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            step = np.zeros(len(batch), np.int64)
            for size in np.unique(length):
                here, (low, high) = length == size, bounds[int(size)]
                step[here] = low + np.searchsorted(steps[low:high, 1], rank[here], side="right") - 1
            _, first_rank, _, first, each, offset = steps[step].T
            number, place = np.divmod(rank - first_rank, np.maximum(each, 1))
            added = [pa.array(first + number), pa.array(offset + place * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return ranked.mapInArrow(run, schema).drop("part", "rank")


def pack_documents(docs: DataFrame, text: str = "text", capacity: int = CAPACITY, paths: tuple[str, str | None] | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack: one row per piece."""
    return pack(settle(tokenize(docs, text, capacity, paths, with_ids), "pieces"), capacity)
