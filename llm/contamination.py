"""Benchmark decontamination by a distributed positional inverted index. DataFrame functions only.

Words are maximal runs of digits, letters and characters above ASCII, lower-cased for A-Z only. A benchmark item's windows are its runs of
``width`` words; an item of fewer words, but not none, is one window. A word of a document that stands inside any occurrence of a window is hit.

Index. Every occurrence of a benchmark word in the documents is a posting (term, row, pos), written once, each file holding the postings of its
documents sorted by term: an inverted index split by document. A document of any length is one posting after another, and nothing of it is
gathered. An end mark (the empty term, at the place behind the last word) carries the document's id and its number of words. The postings are
written without a shuffle.

Exact phrases. The lists of a window's terms, moved back by their offsets in the window, hold the places where the window may begin; a
place in all lists is an occurrence. Lists are intersected from the rarest term on: the rarest is looked up where the postings lie; the second leaves about
what occurs; the others are met together, an occurrence being in each. Windows with a word that no document has are dropped before. Later lists are
joined by (row, pos, term), which a document has once, so no key is hot however frequent a word or a passage is.

Proximity. ``near_matches`` finds stretches of at most ``within`` words that hold all different terms of a phrase, in any order, round an occurrence of
its rarest.

Sides that grow with the benchmark (its words, windows and items) are broadcast only when measured to be small, and joined with salted keys else.

Null texts have no words. Rows that repeat, or repeat an id, are documents of their own. Items that share an id count once; a null item id counts as empty. A
text is never cut. Empty tables give empty results, or documents without a hit. Columns other than id and text are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulscore.runtime import lookup_join
from llm.common import ascii_lower, settle

WIDTH = 10
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# The word behind the last one of a document.
END = ""


class Index(NamedTuple):
    """Postings (term, row, pos) of the known words; with the end marks also each document's id; and (word, term, n) with the number of postings."""

    postings: DataFrame
    documents: DataFrame
    terms: DataFrame


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def build_index(docs: DataFrame, wanted: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all documents for the words of ``wanted`` (column ``word``).

    ``documents`` has row, the id under ``doc_id``, and n_words.
    """
    spark = docs.sparkSession
    end = spark.range(1).select(F.lit(END).alias("word"))
    words = wanted.select("word").where(F.col("word") != END).distinct().union(end)
    vocabulary = settle(words.withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    # Numbered before words are listed, so that a document has one number.
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), F.concat(words_of(F.col(text)), F.array(F.lit(END))).alias("words"))
    marked = read.select("row", "doc_id", F.posexplode("words").alias("pos", "word")).withColumn("doc_id", F.when(F.col("word") == END, F.col("doc_id")))
    found = lookup_join(marked, vocabulary, ["word"], "inner")
    lists = found.select("term", "row", "pos", (F.col("word") == END).alias("is_end"), "doc_id")
    written = settle(lists.sortWithinPartitions("term", "row", "pos"), "postings")
    postings = written.where(~F.col("is_end")).select("term", "row", "pos")
    documents = written.where("is_end").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    return Index(postings, documents, settle(vocabulary.join(counts, "term").select("word", "term", "n"), "terms"))


def windows(items: DataFrame, width: int = WIDTH, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): the runs of ``width`` words of each item, or all its words if they are fewer, each once an item."""
    read = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("all"))
    places = read.where(F.size("all") > 0).select("item", "all", F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)))).alias("at"))
    return places.select("item", F.slice("all", F.col("at") + 1, width).alias("words")).distinct()


def phrase_lists(index: Index, phrases: DataFrame) -> DataFrame:
    """(phrase, length, lists): for each phrase whose words all occur, its (n, offset, term), rarest first. ``phrases``: phrase, words."""
    each = phrases.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    known = lookup_join(each, index.terms, ["word"], "inner")
    lists = known.groupBy("phrase", "length").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("lists"))
    return lists.where(F.size("lists") == F.col("length"))


def _needed(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of some terms."""
    return lookup_join(postings, terms.distinct(), ["term"], "inner")


def exact_matches(index: Index, phrases: DataFrame) -> DataFrame:
    """(row, phrase, start, length) of every occurrence of the phrases. ``phrases``: phrase (a unique long), words (an array)."""
    lists = settle(phrase_lists(index, phrases), "phrase-lists")
    first, second = F.col("lists")[0], F.get("lists", F.lit(1))
    heads = lists.select("phrase", "length", first["term"].alias("term"), first["offset"].alias("offset"), second["term"].alias("next"), second["offset"].alias("next_offset"))
    rarest = lookup_join(index.postings, settle(heads, "phrase-heads"), ["term"], "inner").withColumn("start", F.col("pos") - F.col("offset"))
    begun = rarest.where("start >= 0").select("row", "phrase", "start", "length", "next", (F.col("start") + F.col("next_offset")).alias("next_pos"))
    seconds = _needed(index.postings, settle(heads.where("next is not null").select(F.col("next").alias("term")), "second-terms"))
    listed = seconds.select(F.col("row").alias("_row"), F.col("pos").alias("_pos"), F.col("term").alias("_term"))
    met = begun.where("length > 1").join(listed, (F.col("row") == F.col("_row")) & (F.col("next_pos") == F.col("_pos")) & (F.col("next") == F.col("_term")), "left_semi")
    kept = ("row", "phrase", "start", "length")
    two = settle(met.select(*kept).union(begun.where("length = 1").select(*kept)), "two-lists")
    # All other lists at once: an occurrence is in each of them.
    others = lists.where("length > 2").select("phrase", F.explode(F.slice("lists", F.lit(3), F.size("lists"))).alias("l")).select("phrase", F.col("l.offset").alias("offset"), F.col("l.term").alias("term"))
    others = settle(others, "other-lists")
    wanted = lookup_join(two, others, ["phrase"], "inner").select(*kept, F.col("term"), (F.col("start") + F.col("offset")).alias("pos"))
    rows = settle(two.select("row").distinct(), "candidate-rows")
    there = lookup_join(_needed(index.postings, settle(wanted.select("term").distinct(), "other-terms")), rows, ["row"], "inner")
    hits = wanted.join(there, ["row", "pos", "term"]).groupBy(*kept).agg(F.count("*").alias("lists"))
    whole = hits.where(F.col("lists") == F.col("length") - 2).select(*kept)
    return whole.union(two.where("length <= 2"))


def near_matches(index: Index, phrases: DataFrame, within: int) -> DataFrame:
    """(row, phrase, at, first, last): stretches of at most ``within`` words with all different words of a phrase, in any order.

    ``at`` is an occurrence of the phrase's rarest word; the stretch is the shortest that holds it, the first of equally short ones.
    """
    distinct = phrases.select("phrase", F.array_distinct("words").alias("words"))
    lists = settle(phrase_lists(index, distinct), "near-lists")
    heads = lists.select("phrase", "length", F.col("lists")[0]["term"].alias("term"))
    rarest = lookup_join(index.postings, settle(heads, "near-heads"), ["term"], "inner").select("row", "phrase", "length", F.col("pos").alias("at"), F.col("term").alias("own"))
    members = settle(lists.select("phrase", F.explode("lists").alias("l")).select("phrase", F.col("l.term").alias("term")), "near-terms")
    # A stretch round ``at`` lies in the cell of its own or in one beside it, a cell being as wide as a stretch.
    cells = rarest.withColumn("cell", F.explode(F.sequence(F.floor(F.col("at") / within) - 1, F.floor(F.col("at") / within) + 1)))
    asked = lookup_join(cells, members, ["phrase"], "inner")
    there = _needed(index.postings, members.select("term")).withColumn("cell", F.floor(F.col("pos") / within))
    around = asked.join(there, ["row", "cell", "term"]).where(F.abs(F.col("pos") - F.col("at")) < within)
    # At most 2 * within - 1 places each.
    gathered = around.groupBy("row", "phrase", "length", "at").agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("places"))

    def stretch(begin: Column) -> Column:
        inside = F.filter("places", lambda p: (p["pos"] >= begin) & (p["pos"] < begin + within))
        # The last of the first places of the terms is where the stretch may end.
        terms = F.array_distinct(F.transform(inside, lambda p: p["term"]))
        ends = F.transform(terms, lambda t: F.array_min(F.transform(F.filter(inside, lambda p: p["term"] == t), lambda p: p["pos"])))
        last = F.greatest(F.array_max(ends), F.col("at"))
        return F.when(F.size(terms) == F.col("length"), F.struct((last - begin).alias("width"), begin.alias("first"), last.alias("last")))

    begins = F.filter("places", lambda p: p["pos"] <= F.col("at"))
    best = F.array_min(F.filter(F.transform(begins, lambda p: stretch(p["pos"])), lambda s: s.isNotNull()))
    return gathered.withColumn("best", best).where(F.col("best").isNotNull()).select("row", "phrase", "at", "best.first", "best.last")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row a document: its id under ``doc_id``, n_words, n_hit, n_items, item_ids (sorted as strings) and contaminated."""
    listed = settle(windows(items, width, item_key, item_text), "windows")
    numbered = settle(listed.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    members = settle(listed.join(numbered, "words").select("phrase", "item"), "phrase-items")
    index = build_index(docs, numbered.select(F.explode("words").alias("word")), key, text)
    found = settle(exact_matches(index, numbered), "occurrences")
    hit = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    of_items = lookup_join(found.select("row", "phrase").distinct(), members, ["phrase"], "inner").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    told = index.documents.join(hit, "row", "left").join(of_items, "row", "left")
    ids, n_hit = F.coalesce("item_ids", F.array().cast("array<string>")), F.coalesce("n_hit", F.lit(0)).cast("long")
    return told.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (n_hit > 0).alias("contaminated"))
