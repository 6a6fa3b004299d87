"""Spelling variants: words that differ by one inserted, deleted or replaced character, found by permuterm rotations.

Words are maximal runs of Latin letters of a least length that occur a least number of times. Two are near if one edit of one code point
turns the one into the other. A word's form is its near word with the largest count (of equal ones the first in code-point order), if that is
``ratio`` times the word's own count or more; its root is where following forms ends. Counts grow from word to form, so there is no circle.

Method. A word w with the terminator ``END`` has the rotations w[i:] END w[:i]. An edit at place i leaves w[i+1:] END w[:i] alone, which is the
rotation that begins behind i without its last character. So words that replace the character at i share that prefix with it and have one more character each, and the word
that lacks the character *is* the prefix. All rotations are sorted by prefix, whole ones before those with a character more; a prefix and its
rotations stand together, and one scan of the sorted rows meets every near pair. A prefix fixes the word but for one character, so a group holds at most a row for each
letter of the alphabet and one: no group grows with the data. A pair that inserts into a run of equal characters shares several
prefixes; only the first place of the run counts.

The scan yields for each word and prefix the number of near words and the best of them, not the pairs; ``near_pairs`` lists the pairs
as well. Ranges of prefixes come from a sample of the rows, which steers the partitions only. Forms are followed by doubling, in rounds
that grow with the logarithm of the longest chain; a chain is at most as long as the decimal logarithm of the largest count.

Null texts have no words, a null id counts as the empty text, repeated rows count as often as they stand there, texts of any length are read in
pieces, an empty table gives an empty table, and columns other than the two named are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import forget, settle, slices, text_bytes

SHORTEST = 7
LEAST = 2
RATIO = 10
# Sorts before every letter and is none.
END = "$"
# Distinct words a task holds before it hands them on, and bytes of text read at once.
HELD = 200_000
PIECE = 1 << 20

_BETWEEN = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")

# (text of the document's id, word) -> word
Change = Callable[[str, str], str]


def runs_of(raw: bytes, shortest: int = SHORTEST, piece: int = PIECE) -> Counter:
    """Maximal runs of Latin letters with at least ``shortest`` code points, lower-cased for A-Z, counted."""
    wanted = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")
    found: Counter = Counter()
    begin = 0
    while begin < len(raw):
        end = len(raw)
        if begin + piece < end:
            gap = _BETWEEN.search(raw, begin + piece)
            end = gap.end() if gap else end
        found.update(wanted.findall(raw[begin:end].lower().decode()))
        begin = end
    return found


def without_a_letter(doc_id: str, word: str, every: int = 31) -> str:
    """The word less one letter in about one of ``every`` (document, word) pairs, chosen and placed by crc32."""
    h = crc32(f"{doc_id}:{word}".encode())
    at = h % len(word)
    return word if h % every else word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, change: Change | None = None) -> DataFrame:
    """(word, n) of the words that occur ``least`` times. ``change`` may alter a word of a document, or shorten it below the least length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            ids = batch.column("key")
            _, starts = text_bytes(batch.column("text"))
            for first, last in slices(starts, PIECE):
                data, at = text_bytes(batch.column("text").slice(first, last - first))
                raw = data.tobytes()
                for i in range(last - first):
                    doc_id = ids[first + i].as_py()
                    for word, n in runs_of(raw[at[i] : at[i + 1]], shortest).items():
                        if change is not None:
                            word = change(doc_id, word)
                            if len(word) < shortest:
                                continue
                        held[word] = held.get(word, 0) + n
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(held.values(), pa.int64())], names=["word", "n"])
                    held = {}
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    slim = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, letter, first, n): each rotation less its last letter, and each whole one with an empty letter.

    ``first``: the letter before the edited one is another one.
    """
    word, i = F.col("word"), F.col("i")

    def turned(at: Column) -> Column:
        """The rotation that begins at a place, up to the place ``i``."""
        return F.concat(F.substring(word, at + 1, F.length(word)), F.lit(END), F.substring(word, F.lit(1), i))

    letter = F.substring(word, i + 1, F.lit(1))
    whole = F.struct(turned(i).alias("prefix"), F.lit("").alias("letter"), F.lit(True).alias("first"))
    shorter = F.struct(turned(i + 1).alias("prefix"), letter.alias("letter"), ((i == 0) | (letter != F.substring(word, i, F.lit(1)))).alias("first"))
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    # Behind the last letter there is none to edit.
    rows = places.select("n", F.explode(F.when(i < F.length("word"), F.array(whole, shorter)).otherwise(F.array(whole))).alias("r"))
    return rows.select("r.prefix", "r.letter", "r.first", "n")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, int, bool]], int | None]]:
    """(prefix, letters with count and ``first``, the whole word's count) of every prefix with two rows or more; rows come sorted by prefix and letter."""
    left: pa.RecordBatch | None = None

    def of(rows: pa.RecordBatch, edges: list[int]):
        long = [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a + 1]
        letters, firsts, ns = (rows.column(name).to_pylist() for name in ("letter", "first", "n"))
        prefixes = rows.column("prefix").take(pa.array([a for a, _ in long], pa.int64())).to_pylist()
        for prefix, (a, b) in zip(prefixes, long, strict=True):
            whole = None if letters[a] else ns[a]
            yield prefix, [(letters[j], ns[j], firsts[j]) for j in range(a + (whole is not None), b)], whole

    for batch in batches:
        if left is not None:
            batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        if not len(batch):
            continue
        prefix = batch.column("prefix")
        new = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False).nonzero()[0] + 1
        edges = [0, *new.tolist()]
        left = batch.slice(edges[-1])
        yield from of(batch, edges)
    if left is not None:
        yield from of(left, [0, len(left)])


def _words_of(prefix: str) -> tuple[str, str]:
    behind, _, before = prefix.partition(END)
    return before, behind


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, best_n, best) of each word in each group."""
    out: list[tuple[str, int, int, str]] = []

    def done() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "near", "best_n", "best"])

    for prefix, letters, whole_n in _groups(batches):
        before, behind = _words_of(prefix)
        members = sorted((-n, before + letter + behind, first) for letter, n, first in letters)
        whole = None if whole_n is None else (-whole_n, before + behind)
        for i, (_, word, first) in enumerate(members):
            near = len(members) - 1
            best = members[1 if i == 0 else 0][:2] if near else None
            if whole and first:
                near += 1
                best = whole if best is None else min(best, whole)
            if near:
                out.append((word, near, -best[0], best[1]))
        if whole:
            longer = [m for m in members if m[2]]
            if longer:
                out.append((whole[1], len(longer), -longer[0][0], longer[0][1]))
        if len(out) > 20_000:
            yield done()
    yield done()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for prefix, letters, whole_n in _groups(batches):
        before, behind = _words_of(prefix)
        words = [before + letter + behind for letter, _, _ in letters]
        found = [(a, b, "replaced") for i, a in enumerate(words) for b in words[i + 1 :]]
        if whole_n is not None:
            found += [(before + behind, word, "inserted") for word, (_, _, first) in zip(words, letters, strict=True) if first]
        columns = list(zip(*found, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["a", "b", "edit"])


def _sorted_rotations(words: DataFrame) -> DataFrame:
    return rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "letter")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, edit): every pair of near words once; ``inserted``: b has one letter more."""
    return _sorted_rotations(words).mapInArrow(_pairs, "a string, b string, edit string")


def best_near(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of the words that have near ones."""
    found = _sorted_rotations(words).mapInArrow(_scan, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: forms are followed to the last, each round twice as far as the one before."""
    spark = forms.sparkSession
    reached = settle(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = settle(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        forget(spark, reached)
        reached = joined
        if reached.where("moved").isEmpty():
            return reached.drop("moved")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, change: Change | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    words = settle(count_words(docs, key, text, shortest, least, change), "words")
    near = words.join(best_near(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    named = settle(
        near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "variants",
    )
    found = roots(named.where(F.col("form").isNotNull()).select("word", "form"))
    return named.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
