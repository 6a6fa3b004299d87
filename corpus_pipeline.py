"""The corpus pipeline: language ID, near-duplicates, repeated passages, source mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's documents. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import language_id, mixing, packing, repeats, simhash
from llm.common import settle, table

# A document whose language is undetermined, or less likely than this against the others, goes.
LEAST_SCORE = 0.5
# As many tokens as the corpus has, drawn flatter where the sources are too uneven; even sources stay as they are.
MIXTURE = mixing.Target(entropy=0.95, most_repeats=4.0, budget=1.0, highest_exponent=1.0)


def _columns(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*like.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go; the languages are learned from the labelled documents at hand."""
    model = language_id.fit(language_id.training_sample(docs))
    found = language_id.identify(docs, model, prediction="_lang", score="_score")
    return _columns(found.where((F.col("_lang") != language_id.UNDETERMINED) & (F.col("_score") >= LEAST_SCORE)), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return _columns(simhash.keep_first(docs), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; documents of which nothing is left go. n_chars follows the text."""
    cut = repeats.remove_repeats(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return _columns(left, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Uneven sources are drawn to a flatter mixture, small ones up to four times; of even ones every document is drawn once."""
    return _columns(mixing.mix(docs, mixing.plan(docs, MIXTURE)), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
# Byte-context models, fingerprints and tokenizers have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
