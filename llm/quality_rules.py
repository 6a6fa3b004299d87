"""Quality rules as a short-circuit cascade, in built-in functions only.

Each rule rejects documents. Its cost and its rejected share are measured on a sample, and the cascade asks the rule with
most rejection per cost first, each next rule only of documents that all earlier ones kept. The order changes the work,
never the verdict: a document is kept if no rule rejects it.

Null and empty texts have no words and fail the length rule. Repeated rows are judged each for itself. Columns of the
input stay; measures are added under the names in ``MEASURES``, replacing columns of these names. An empty table stays empty. A text of any length is judged
whole: its words and window hashes are held, some 30 bytes a word. Input columns whose names begin with an underscore are not kept.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import once, settle, words

# White space as characters, and the characters that count as symbols.
BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Rows, at most in the mean, that costs and rejected shares are measured on. It steers the order alone.
SAMPLE_ROWS = 2_000
# How often a rule is asked of each sampled row, and the least cost told from none, as a share of the time without a rule.
TIMES = 8
LEAST_COST = 0.25
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true or false for every document; it may read the text and the measures."""

    name: str
    rejects: Column


def default_rules(text: str = "text") -> list[Rule]:
    column = F.coalesce(F.col(text), F.lit(""))
    lines = F.size(F.split(column, "\n"))
    shouted = F.length(column) - F.length(F.regexp_replace(column, "\\p{Lu}", ""))
    letters = F.length(column) - F.length(F.regexp_replace(column, "\\p{L}", ""))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words")),
        Rule("word_length", ~F.col("word_chars").between(F.col("n_words") * 2, F.col("n_words") * 20)),
        Rule("duplicate_lines", (F.col("n_dup_lines") >= 3) & (F.col("n_dup_lines") * 10 > lines * 3)),
        Rule("shouting", shouted * 2 > letters),
        Rule("no_letters", letters * 2 < F.col("word_chars")),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures, each over the whole text.

    Repeated windows are found inside one row: window hashes (64 bits, told apart within one text) are sorted, so equal
    ones lie side by side, and each repeated window covers the words up to the next one, three at most.
    """
    column = F.coalesce(F.col(text), F.lit(""))
    tokens, hashes, places, hits = (F.col(f"_{x}") for x in ("tokens", "hashes", "places", "hits"))
    lines = F.filter(F.split(column, "\n"), lambda line: F.length(F.translate(line, BLANK_CHARS, "")) > 0)
    no_hashes, no_places = F.array().cast("array<bigint>"), F.array().cast("array<struct<h:bigint,i:int>>")
    same = lambda k, j, x: F.coalesce(F.get(places, k + j)["h"] == x["h"], F.lit(False))
    return (
        docs.withColumn("_tokens", words(F.col(text)))
        .withColumn(
            "_hashes",
            F.when(
                F.size(tokens) >= 3, F.transform(F.sequence(F.lit(1), F.size(tokens) - 2), lambda i: F.xxhash64(F.slice(tokens, i, 3)))
            ).otherwise(no_hashes),
        )
        .withColumn(
            "_places",
            # Most texts repeat no window; only the others are sorted.
            F.when(
                F.size(F.array_distinct(hashes)) < F.size(hashes),
                F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(no_places),
        )
        .withColumn(
            "_hits",
            F.sort_array(
                F.transform(F.filter(places, lambda x, k: same(k, -1, x) | same(k, 1, x)), lambda x: x["i"])
            ),
        )
        .withColumn(
            "_measures",
            once(
                F.struct(
                    F.size(tokens).cast("long").alias("n_words"),
                    F.length(F.translate(column, BLANK_CHARS, "")).cast("long").alias("word_chars"),
                    (F.length(column) - F.length(F.translate(column, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                    F.aggregate(
                        F.transform(hits, lambda i, k: F.coalesce(F.least(F.get(hits, k + 1) - i, F.lit(3)), F.lit(3))),
                        F.lit(0).cast("long"),
                        lambda total, x: total + x,
                    ).alias("n_repeat_words"),
                )
            ),
        )
        .withColumns({name: F.col(f"_measures.{name}") for name in MEASURES})
        .drop("_tokens", "_hashes", "_places", "_hits", "_measures")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def rank_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Order rules by rejected share per second, both measured on a sample of about ``sample_rows`` documents.

    Rules too cheap to be told apart are ordered
    by what they reject. An empty table keeps the given order. Ties keep it as well.
    """
    total = docs.count()
    if not total or len(rules) < 2:
        return list(rules)
    share = min(1.0, sample_rows / total)
    sample = settle(measured(docs.select(text).sample(share, seed=7), text), "rule-sample")
    # Many times over each row, so that a rule's own time stands above that of a job.
    often = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))

    def asked(condition: Column) -> tuple[float, float]:
        took, rejected = [], 0.0
        for _ in range(2):
            began = time.perf_counter()
            rejected = often.agg(F.avg(condition.cast("int")), F.max(F.length(text))).first()[0] or 0.0
            took.append(time.perf_counter() - began)
        return min(took), rejected

    idle, _ = asked(F.lit(False))
    worth = {}
    for rule in rules:
        seconds, rejected = asked(rule.rejects)
        worth[rule.name] = rejected / max(seconds - idle, idle * LEAST_COST)
    return sorted(rules, key=lambda rule: -worth[rule.name])


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add the measures, ``base_failed``, ``kept`` and ``rejected_by`` (the first rule of the chosen order that rejects)."""
    ranked = rank_rules(docs, default_rules(text) if rules is None else rules, text, sample_rows)
    verdict = F.when(base_failed(), F.lit("base"))
    for rule in ranked:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    out = measured(docs, text).withColumn("rejected_by", verdict)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", F.col("rejected_by").isNull())
