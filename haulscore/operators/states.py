"""Stored partial results that a new year's hauls are merged into.

Percentiles come from value counts (how often each value of a metric occurs, per year and group), means and errors from moments (number, sum and
sum of squares per year and segment, in decimals). Both merge by plain sums whose result does not depend on the
order, so a refresh gives the same bits as a computation over all rows, and reads the new rows only. Stored states are partitioned by year:
reference years are read alone, and each refresh adds files of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import INDEX_METRICS, REFERENCE_PROBS, REFERENCE_YEARS, UNROUNDED_METRICS
from ..functions.expressions import ratio, round_half_even
from ..functions.prefix import BLOCK_ROWS, running_sums
from ..functions.quantiles import prob_label
from ..runtime import settle

GROUP = ("bay_segment", "Season")
# Values of an index score are kept to this many decimals in sums; squares to twice as many.
VALUE, SQUARE = "decimal(16,10)", "decimal(33,20)"
KINDS = ("values", "moments")


def value_states(metrics: DataFrame, names: Sequence[str] = tuple(INDEX_METRICS), by: Sequence[str] = GROUP) -> DataFrame:
    """(Year, group, metric, value, copies): value counts, combined before their shuffle. NULLs are skipped."""
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("v")
    rows = metrics.select("Year", *by, listed).select("Year", *by, "v.*").where(F.col("value").isNotNull())
    return rows.groupBy("Year", *by, "metric", "value").agg(F.count(F.lit(1)).alias("copies"))


def moment_states(scores: DataFrame, score: str = "Index_Score", by: Sequence[str] = ("bay_segment",)) -> DataFrame:
    """(Year, group, hauls, known, total, squares) of a score."""
    value = F.col(score).cast(VALUE)
    return scores.groupBy("Year", *by).agg(
        F.count(F.lit(1)).alias("hauls"), F.count(value).alias("known"), F.sum(value).alias("total"), F.sum((value * value).cast(SQUARE)).alias("squares")
    )


def merged(states: DataFrame) -> DataFrame:
    """One row a key, from partial rows of several refreshes. A missing sum adds nothing."""
    sums = [c for c in ("copies", "hauls", "known", "total", "squares") if c in states.columns]
    return states.groupBy(*[c for c in states.columns if c not in sums]).agg(*[F.sum(c).cast(states.schema[c].dataType).alias(c) for c in sums])


def append_states(states: DataFrame, folder: str, kind: str) -> None:
    """Add the states of new rows to the stored ones; no stored file is read or rewritten."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    states.write.mode("append").partitionBy("Year").parquet(f"{folder}/{kind}")


def stored_states(spark: SparkSession, folder: str, kind: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The merged states of some years, or of all."""
    states = spark.read.parquet(f"{folder}/{kind}")
    if years is not None:
        states = states.where(F.col("Year").between(*years))
    return merged(states.select(*[F.col(c).cast("int") if c == "Year" else F.col(c) for c in states.columns]))


def quantiles_of_counts(counts: DataFrame, by: Sequence[str], probs: Sequence[float], block_values: int = BLOCK_ROWS) -> DataFrame:
    """(by, P<100p> ...): exact percentiles of counted values, by linear interpolation at position (n - 1)p, NaN last.

    Ranks are running sums of the copies over blocks of values, so a group of any number of values is spread over tasks. Equal neighbours are
    returned as they are, others are weighted as Spark's own percentile weights them.
    """
    # One key and a rank that grows downwards, as running sums take them.
    keyed = settle(counts.groupBy(*by, "value").agg(F.sum("copies").alias("copies")).select(F.struct(*by).alias("key"), "value", "copies"), "counted-values")
    placed = running_sums(keyed, "key", "value", ["copies"], block_values)
    n, copies = F.col("copies_total"), F.col("copies")
    start = n - F.col("copies_through")
    found = []
    for i, p in enumerate(probs):
        position = (n - 1) * F.lit(float(p))
        rank = F.floor(position)

        def holds(at: Column) -> Column:
            return F.max(F.when((at >= start) & (at < start + copies), F.col("value")))

        found += [holds(rank).alias(f"low{i}"), holds(rank + 1).alias(f"high{i}"), F.max(position).alias(f"position{i}"), F.max(rank).alias(f"rank{i}")]
    ends = placed.groupBy("key").agg(*found)

    def quantile(i: int) -> Column:
        low, high, position, rank = (F.col(f"{c}{i}") for c in ("low", "high", "position", "rank"))
        return F.when((position == rank) | (low == high), low).otherwise((rank + 1 - position) * low + (position - rank) * high)

    return ends.select(*[F.col(f"key.{c}").alias(c) for c in by], *[quantile(i).alias(prob_label(p)) for i, p in enumerate(probs)])


def conditions_from_states(values: DataFrame, years: tuple[int, int] = REFERENCE_YEARS, probs: Sequence[float] = REFERENCE_PROBS, by: Sequence[str] = GROUP) -> DataFrame:
    """The reference conditions of ``reference_conditions``, from value counts of some or all years."""
    found = quantiles_of_counts(values.where(F.col("Year").between(*years)), [*by, "metric"], probs)
    labels = [prob_label(p) for p in probs]
    cells = []
    for name in INDEX_METRICS:
        for label in labels:
            cell = F.max(F.when(F.col("metric") == name, F.col(label)))
            cells.append((cell if name in UNROUNDED_METRICS else round_half_even(cell)).alias(f"{name}_{label}"))
    return found.groupBy(*by).agg(*cells)


def _mean(known: Column, hauls: Column, total: Column) -> Column:
    """NULL where a score is missing. The quotient of a decimal sum and a count, as a double."""
    return F.when(known == hauls, ratio(total.cast("double"), hauls.cast("double")))


def yearly_from_states(moments: DataFrame) -> DataFrame:
    """The yearly means, errors and bounds of ``yearly_scores``, from moments."""
    years = merged(moments.drop("bay_segment"))
    n, total = F.col("hauls").cast("double"), F.col("total").cast("double")
    spread = F.greatest(F.col("squares").cast("double") - ratio(total * total, n), F.lit(0.0))
    error = F.when((F.col("known") == F.col("hauls")) & (n > 1), F.sqrt(ratio(spread, n - 1)) / F.sqrt(n))
    means = years.select("Year", round_half_even(_mean(F.col("known"), F.col("hauls"), F.col("total"))).alias("Yr_Index"), error.alias("SEM"))
    return means.withColumns({"lower_sem": F.col("Yr_Index") - F.col("SEM"), "upper_sem": F.col("Yr_Index") + F.col("SEM")})


def segments_from_states(moments: DataFrame, name: str = "Segment_Index") -> DataFrame:
    """The means of ``segment_scores``, from moments."""
    return merged(moments).select("bay_segment", "Year", round_half_even(_mean(F.col("known"), F.col("hauls"), F.col("total"))).alias(name))
