"""Mixing sources to target weights by temperature, in built-in functions only.

A source's weight is its token share raised to an exponent and normalised: 1 keeps the corpus as it is, 0 gives every source the
same. The target entropy is a floor, either fixed or a part of the way from the corpus's own to the largest: a corpus that reaches it stays as it is, else the exponent is bisected below 1 until the weights
reach it, and raised again where a small source would be repeated more often than the limit allows. The entropy reached is a column of the plan. Weights times the token budget are the sources' budgets.

A budget is spent in epochs. Each epoch permutes the source's blocks, and the documents inside a block, by hash. Whole epochs take
every document; the last one takes documents in permuted order while their tokens fit. If that leaves more than a sixteenth of the source's budget
unspent, the document that crosses the budget is drawn too where this comes closer. Documents at least twice as long as the last epoch's
budget cannot come closer and are passed over, so none behind them is lost. A source with any budget gets one document at least, even if that is longer.
Where the last epoch ends is one cut per source, a block key and a document key, so every document decides for itself how often it is drawn. Blocks are summed before they are ordered, and only
the one block at the cut is read document by document, so a source with a third of all rows is never sorted as a whole.

Tokens are words. Null and empty texts have none and are drawn with the documents around them. A null source is a source of its own. Rows that
repeat an id and a text are told apart by nothing and drawn alike, ones at the cut together or not at all. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulscore.runtime import lookup_join
from llm.common import BLANKS, settle

BLANK_CHARS = " \t\n\x0b\x0c\r"
# Documents in a block, in the mean.
BLOCK_DOCS = 1024
# Bisections that one pass over the sources answers, and passes: 2 ** -30 of the exponent's range is left.
LEVELS, PASSES = 5, 6
# A source may stay this share of its budget short: documents are whole.
SHORT = 1 / 16
SEED = 17


@dataclass(frozen=True)
class Target:
    """What the mixture should meet. ``entropy``, a share of the largest possible one, ln(number of sources), should be reached or exceeded."""

    entropy: float | None = 0.95
    most_repeats: float = 4.0
    budget: float = 1.0  # tokens to draw, as a multiple of the corpus; no more than most_repeats
    closer: float = 0.0  # the share of the corpus's own distance from the largest entropy that should be closed besides
    highest_exponent: float = 1.0  # less than 1 flattens more than the entropy asks for; more than 1 counts as 1: nothing makes large sources larger


def token_count(text: Column) -> Column:
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, BLANKS))).cast("long")


def _bisect(sources: DataFrame, low: float, high: float, enough) -> float:
    """The least exponent in [low, high] for which ``enough`` holds, if it holds from some exponent on.

    ``enough`` makes of an aggregate at exponent column ``a`` (over ln share ``l``) a true or false column. A pass looks at all exponents that
    the next LEVELS bisections could ask for.
    """
    parts = 1 << LEVELS
    for _ in range(PASSES):
        grid = [low + (high - low) * i / parts for i in range(parts + 1)]
        asked = sources.withColumn("a", F.explode(F.array(*(F.lit(a) for a in grid))))
        answers = {row["a"]: row["yes"] for row in enough(asked).collect()}  # one row for each exponent of the grid
        good = next((i for i, a in enumerate(grid) if answers.get(a)), None)
        if good is None:
            return high
        if good == 0:
            return low
        low, high = grid[good - 1], grid[good]
    return high


def exponent(sources: DataFrame, target: Target, tokens: int, largest: int, n_sources: int) -> float:
    """The exponent for sources with columns ``tokens`` and ``l``, the log of tokens over the largest source's."""
    budget = min(target.budget, target.most_repeats)
    z, zl = F.sum(F.exp(F.col("a") * F.col("l"))), F.sum(F.exp(F.col("a") * F.col("l")) * F.col("l"))
    found = min(1.0, target.highest_exponent)
    if (target.entropy is not None or target.closer) and n_sources > 1:
        own = sources.agg(F.sum(F.exp("l")).alias("z"), F.sum(F.exp("l") * F.col("l")).alias("zl")).first()
        here, most = math.log(own["z"]) - own["zl"] / own["z"], math.log(n_sources)
        wanted = max((target.entropy or 0.0) * most, here + target.closer * (most - here))
        # Entropy falls as the exponent rises: look for the last exponent that still reaches the target.
        entropy = F.ln(z) - F.col("a") * zl / z
        found = _bisect(sources, 0.0, found, lambda f: f.groupBy("a").agg((entropy <= wanted).alias("yes")))
    if found < 1.0:
        # A source is drawn weight * budget / share times, most often for the smallest source.
        ratio = F.max(F.exp(F.col("a") * F.col("l")) / F.exp("l")) / z * (tokens / largest) * budget
        found = max(found, _bisect(sources, 0.0, 1.0, lambda f: f.groupBy("a").agg((ratio <= target.most_repeats).alias("yes"))))
    return found


def plan(docs: DataFrame, target: Target, key: str = "doc_id", text: str = "text", source: str = "source", block_docs: int = BLOCK_DOCS, seed: int = SEED) -> DataFrame:
    """One row per source: tokens, weight, budget, whole epochs, number of blocks, exponent and entropy reached, and the cut of the last epoch."""
    rows = settle(
        docs.select(_named(source).alias("s"), _identity(key, text).alias("h"), token_count(F.col(text)).alias("t")), "mix-rows"
    )
    totals = settle(rows.groupBy("s").agg(F.sum("t").alias("tokens"), F.count("*").alias("docs"), F.min(F.when(F.col("t") > 0, F.col("t"))).alias("shortest")), "mix-sources")
    whole = totals.agg(F.sum("tokens").alias("t"), F.max("tokens").alias("m"), F.sum((F.col("tokens") > 0).cast("long")).alias("n")).first()
    tokens, largest, n_sources = whole["t"] or 0, whole["m"] or 1, whole["n"] or 0
    spoken = totals.where("tokens > 0").withColumn("l", F.ln(F.col("tokens") / F.lit(float(max(largest, 1)))))
    a = exponent(spoken, target, tokens, largest, n_sources) if n_sources else 1.0
    powered = spoken.withColumn("w", F.exp(F.lit(a) * F.col("l")))
    summed = powered.agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.col("l")).alias("zl")).first()
    z = summed["z"] or 1.0
    # Of the weights, as a share of the largest possible one; a lone source has all of it.
    reached = (math.log(z) - a * (summed["zl"] or 0.0) / z) / math.log(n_sources) if n_sources > 1 else 1.0
    spend = min(target.budget, target.most_repeats) * tokens
    # What is a whole number of epochs but for rounding and the bisection's last step is that number.
    exact = F.col("w") / F.lit(z) * F.lit(float(spend))
    even = F.round(exact / F.col("tokens")) * F.col("tokens")
    exact = F.when(F.abs(exact - even) <= F.greatest(F.col("tokens") * F.lit(1e-6), F.lit(1e-3)), even).otherwise(exact)
    budget = F.least(F.round(exact), F.floor(F.col("tokens") * F.lit(target.most_repeats))).cast("long")
    budget = F.when(F.col("tokens") > 0, F.greatest(budget, F.lit(1 if spend > 0 else 0).cast("long")))
    sources = totals.join(powered.select("s", "w"), "s", "left").select("s", "tokens", "docs", "shortest", F.coalesce(F.col("w") / F.lit(z), F.lit(0.0)).alias("weight"), F.coalesce(budget, F.lit(0)).alias("budget"))
    sources = (
        sources.withColumn("epochs", F.coalesce(F.floor(F.try_divide("budget", "tokens")), F.lit(1)).cast("long"))
        .withColumn("rest", (F.col("budget") - F.col("epochs") * F.col("tokens")).cast("long"))
        # Longer documents are passed over in the last epoch.
        .withColumn("below", F.greatest(2 * F.col("rest"), F.when((F.col("epochs") == 0) & (F.col("rest") > 0), F.col("shortest") + 1)).cast("long"))
        .drop("shortest")
        .withColumn("blocks", F.greatest(F.ceil(F.col("docs") / block_docs), F.lit(1)).cast("long"))
        .withColumn("exponent", F.lit(a))
        .withColumn("entropy", F.lit(reached))
    )
    sources = settle(sources, "mix-budgets")
    placed = lookup_join(rows, sources.select("s", "epochs", "rest", "blocks", "budget", "below"), ["s"], "inner").where((F.col("rest") > 0) & (F.col("t") < F.col("below")))
    placed = placed.withColumn("block", _block(F.col("h"), F.col("blocks"))).withColumn("bk", _block_key(F.col("s"), F.col("block"), F.col("epochs"), seed)).withColumn("dk", _doc_key(F.col("h"), F.col("epochs"), seed))
    sums = placed.groupBy("s", "block", "bk", "rest").agg(F.sum("t").alias("t"))
    until = F.sum("t").over(Window.partitionBy("s").orderBy("bk", "block").rowsBetween(Window.unboundedPreceding, 0))
    over = sums.withColumn("until", until).where(F.col("until") > F.col("rest"))
    cut = over.groupBy("s").agg(F.min(F.struct("bk", "block", F.col("rest") - F.col("until") + F.col("t"))).alias("c")).select("s", "c.*").toDF("s", "cut_bk", "cut_block", "room")
    cut = settle(cut, "mix-cuts")
    inside = placed.join(cut.select("s", F.col("cut_block").alias("block"), "room"), ["s", "block"])
    inside = inside.groupBy("s", "dk", "room", "rest", "budget", "epochs").agg(F.sum("t").alias("t"))
    run = inside.withColumn("until", F.sum("t").over(Window.partitionBy("s").orderBy("dk").rowsBetween(Window.unboundedPreceding, 0)))
    # With the document that crosses, the source is ``until - room`` over its budget; without it, ``short`` below.
    short = F.col("room") - F.col("until") + F.col("t")
    closer = (F.col("until") - F.col("room") <= short) & (short > F.col("budget") * SHORT)
    nothing = (F.col("epochs") == 0) & (short == F.col("rest"))
    crossing = (F.col("until") - F.col("t") <= F.col("room")) & (closer | nothing)
    ends = run.where((F.col("until") <= F.col("room")) | crossing).groupBy("s").agg(F.max("dk").alias("cut_dk"))
    cut = cut.join(ends, "s", "left").select("s", "cut_bk", "cut_block", "cut_dk")
    return settle(sources.join(cut, "s", "left").withColumn("source", F.when(F.col("s") != "", F.substring("s", 2, 1 << 30))), "mix-plan")


def _named(source: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _identity(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))))


def _block(h: Column, blocks: Column) -> Column:
    return F.pmod(h, blocks)


def _block_key(source: Column, block: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), source, block, epoch)


def _doc_key(h: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), h, epoch)


def mix(docs: DataFrame, planned: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The drawn documents, once for each epoch that draws them.

    Adds ``epoch``, ``block``, ``block_key`` and ``doc_key``; an epoch's permutation is the order of (block_key, block, doc_key).
    """
    cuts = planned.select(F.col("s").alias("_s"), *(F.col(c).alias(f"_{c}") for c in ("epochs", "blocks", "cut_bk", "cut_block", "cut_dk", "rest", "below")))
    joined = lookup_join(docs.drop("epoch", "block", "block_key", "doc_key").withColumn("_s", _named(source)), cuts, ["_s"], "inner")
    joined = joined.withColumn("_h", _identity(key, text)).withColumn("block", _block(F.col("_h"), F.col("_blocks")))
    bk, dk = _block_key(F.col("_s"), F.col("block"), F.col("_epochs"), seed), _doc_key(F.col("_h"), F.col("_epochs"), seed)
    before = (bk < F.col("_cut_bk")) | ((bk == F.col("_cut_bk")) & (F.col("block") < F.col("_cut_block")))
    at = (bk == F.col("_cut_bk")) & (F.col("block") == F.col("_cut_block")) & F.coalesce(dk <= F.col("_cut_dk"), F.lit(False))
    # A text has fewer words than bytes: few need counting.
    eligible = (F.octet_length(F.coalesce(F.col(text), F.lit(""))) < F.col("_below")) | (token_count(F.col(text)) < F.col("_below"))
    partial = (F.col("_rest") > 0) & eligible & F.when(F.col("_cut_bk").isNull(), True).otherwise(before | at)
    last = F.col("_epochs") - F.when(partial, 0).otherwise(1)
    drawn = joined.withColumn("_last", last).where("_last >= 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    drawn = drawn.withColumn("block_key", _block_key(F.col("_s"), F.col("block"), F.col("epoch"), seed)).withColumn("doc_key", _doc_key(F.col("_h"), F.col("epoch"), seed))
    return drawn.drop("_epochs", "_blocks", "_cut_bk", "_cut_block", "_cut_dk", "_rest", "_below", "_h", "_last", "_s")
