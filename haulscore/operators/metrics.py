"""The 32 community metrics of a haul."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GUILD_FLAGS, NO_FISH, SENTINEL_SPECIES
from ..functions.expressions import ratio, season, zero_if
from ..functions.prefix import BLOCK_ROWS, running_sums
from ..runtime import lookup_join, settle

TAXA = [f"{name}Taxa" for name, _, _ in GUILD_FLAGS]
ABUNDANCES = [f"{name}Abund" for name in ("TS", "TG", "Benthic", "Pelagic", "Obl", "ES", "MS")]
PROPORTIONS = [f"Prop{name}" for name in ("TG", "TS", "Benthic", "Pelagic", "Obl", "MS", "ES", "Select")]
METRICS = [
    "NumTaxa",
    "NumIndiv",
    "Shannon",
    "Simpson",
    "Pielou",
    "TaxaSelect",
    "SelectIndiv",
    "NumGuilds",
    "Taxa90",
    *TAXA,
    *ABUNDANCES,
    "Num_LR",
    *PROPORTIONS,
]
# Metrics that need a haul's rows in order of size.
ORDERED = ("Shannon", "Simpson", "Pielou", "Taxa90")
# Marks a missing amount inside a sum, which it makes NaN: one running value does for sum and check.
MISSING = float("nan")
ATTRIBUTES = ("Year", "Month", "bay_segment", "Longitude", "Latitude")


def sample_metrics(
    counts: DataFrame, sentinel: str = SENTINEL_SPECIES, dominance: float = 0.9, wanted: Sequence[str] = METRICS
) -> DataFrame:
    """One row per haul with the wanted metrics, from one row per haul and species.

    Diversity and dominance need a haul's rows in order of size. For them equal rows of a haul are counted
    first, whatever the size of the tables: then a haul has at most a row per distinct total and class, and n
    distinct totals take n(n+1)/2 individuals. One shuffle by haul then serves the window (total, running sums) and
    the aggregate. All other metrics are plain sums, combined before their only shuffle, so a hot haul leaves each task as one row.

    Missing totals follow the sums they enter: one NULL total makes a haul's NumIndiv, abundances, diversity and
    proportions NULL. A haul without individuals has 0 in every metric.
    """
    attributes = [c for c in ATTRIBUTES if c in counts.columns]

    def flag(test: Column, name: str) -> Column:
        return F.coalesce(test, F.lit(False)).alias(name)

    rows = counts.select(
        "Reference",
        *attributes,
        flag(F.col("NODCCODE") != NO_FISH, "is_taxon"),
        flag(F.col("Scientificname") == sentinel, "is_sentinel"),
        flag(F.col("Selected_Taxa") == "Y", "is_selected"),
        F.when(F.col("Selected_Taxa") == "Y", 1.0)
        .when(F.col("Selected_Taxa") == "N", 0.0)
        .otherwise(MISSING)
        .alias("selection"),
        F.coalesce("Feeding_Guild", F.lit("")).alias("guild"),
        *[flag(F.col(column) == code, f"is_{name}") for name, column, code in GUILD_FLAGS],
        "Total_N",
    )
    total_n = F.col("Total_N")
    ordered = bool(set(wanted) & set(ORDERED))
    if ordered:
        rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("taxa"))
    else:
        rows = rows.withColumn("taxa", F.lit(1))  # each row is one taxon
    taxa = F.col("taxa")

    def times_taxa(value: Column) -> Column:
        return taxa * value

    stock = times_taxa(total_n)
    ranked = _ranked(rows, stock) if ordered else rows

    def number(name: str) -> Column:
        return F.sum(F.when(F.col(name), taxa).otherwise(0)).cast("double")

    def individuals(name: str, of: Column = stock) -> Column:
        return F.sum(F.when(F.col(name), of).otherwise(0.0))

    def or_zero(amount: Column) -> Column:
        return F.nanvl(amount, F.lit(0.0))

    marked_stock = F.coalesce(stock, F.lit(MISSING))
    taxa_select = F.sum(times_taxa(F.col("selection")))
    complete = F.count("Total_N") == F.count(F.lit(1))
    base = ranked.groupBy("Reference", *attributes).agg(
        number("is_taxon").alias("NumTaxa"),
        F.when(complete, F.sum(stock)).alias("NumIndiv"),
        *(_ordered_metrics(taxa, dominance) if ordered else []),
        F.when(~F.isnan(taxa_select), taxa_select).alias("TaxaSelect"),
        or_zero(individuals("is_selected", marked_stock)).alias("SelectIndiv"),
        F.count_distinct("guild").cast("double").alias("NumGuilds"),
        *[number(f"is_{name}").alias(f"{name}Taxa") for name, _, _ in GUILD_FLAGS],
        *[F.when(complete, individuals(f"is_{name}")).alias(f"{name}Abund") for name, _, _ in GUILD_FLAGS],
        or_zero(individuals("is_sentinel", marked_stock)).alias("Num_LR"),
    )
    derived = base.withColumns(
        {
            **({"Pielou": ratio(F.col("Shannon"), F.ln("NumTaxa"))} if ordered else {}),
            **{f"Prop{name}": ratio(F.col(f"{name}Abund"), F.col("NumIndiv")) for name, _, _ in GUILD_FLAGS},
            "PropSelect": F.coalesce(ratio(F.col("SelectIndiv"), F.col("NumIndiv")), F.lit(0.0)),
        }
    )
    empty = F.col("NumIndiv") == 0
    keys = ["Reference", *attributes]
    if "Month" in attributes:
        derived = derived.withColumn("Season", season(F.col("Month")))
        keys.insert(keys.index("Month") + 1, "Season")
    return derived.select(*keys, *[zero_if(empty, F.col(m)).alias(m) for m in METRICS if m in wanted])


def _ranked(rows: DataFrame, stock: Column, block_rows: int | None = None) -> DataFrame:
    """Add a haul's total and the running stock and taxa, largest totals first. Ties give the same results in any order.

    The rows are written once and counted for each haul. Hauls of few rows take a window each, all frames sharing one ordering, so one
    sort serves them. A haul of more than ``block_rows`` different rows is spread over blocks of its totals, with sums carried from block to block.
    """
    most = BLOCK_ROWS if block_rows is None else block_rows
    written = settle(rows.withColumn("stock", stock), "haul-rows")
    large = settle(written.groupBy("Reference").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > most), "large-hauls")
    if large.isEmpty():
        return _in_windows(written)
    marked = lookup_join(written, large, ["Reference"], "left", null_safe=True)
    small = marked.where(F.col("_rows").isNull()).drop("_rows")
    amounts = marked.where(F.col("_rows").isNotNull()).drop("_rows").withColumn("unknown", F.when(F.col("Total_N").isNull(), 1).otherwise(0))
    summed = running_sums(settle(amounts, "large-haul-rows"), "Reference", "Total_N", ["stock", "taxa", "unknown"], most)
    total = F.when(F.col("unknown_total") == 0, F.col("stock_total")).alias("total")
    return _in_windows(small).unionByName(summed.select(*written.columns, total, "stock_through", "taxa_through"))


def _in_windows(rows: DataFrame) -> DataFrame:
    largest_first = Window.partitionBy("Reference").orderBy(F.desc("Total_N"))
    so_far = largest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = largest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    all_counted = F.count("Total_N").over(whole) == F.count(F.lit(1)).over(whole)
    return rows.select(
        "*",
        F.when(all_counted, F.sum("stock").over(whole)).alias("total"),
        F.sum("stock").over(so_far).alias("stock_through"),
        F.sum("taxa").over(so_far).alias("taxa_through"),
    )


def _ordered_metrics(taxa: Column, dominance: float) -> list[Column]:
    """Shannon, Simpson and the number of taxa that make up a share of the haul."""
    total_n, total = F.col("Total_N"), F.col("total")
    # Of a row's equal taxa only so many are needed; the estimate may be off by one in its last bit.
    before = F.col("stock_through") - taxa * total_n
    estimate = F.ceil(ratio(dominance * total - before, total_n))

    def enough(taken: Column) -> Column:
        return ratio(before + taken * total_n, total) >= dominance

    taken = F.when(enough(estimate - 1), estimate - 1).when(enough(estimate), estimate).otherwise(estimate + 1)
    needed = F.col("taxa_through") - taxa + F.greatest(taken, F.lit(1))
    p = ratio(total_n, total)
    return [
        (F.lit(0.0) - F.sum(taxa * (p * F.ln(p)))).alias("Shannon"),
        ratio(F.lit(1.0), F.sum(taxa * p * p)).alias("Simpson"),
        F.min(F.when(ratio(F.col("stock_through"), total) >= dominance, needed)).cast("double").alias("Taxa90"),
    ]


def assemble(first: DataFrame, *others: DataFrame, on: str = "Reference") -> DataFrame:
    """Left joins of metric tables made elsewhere, one row per key each.

    The metrics of this package need none: ``sample_metrics`` computes them in one aggregate.
    """
    return reduce(lambda left, right: left.join(right, on, "left"), others, first)


def pick(counts: DataFrame, names: Sequence[str], sentinel: str = SENTINEL_SPECIES) -> DataFrame:
    """Some metrics by name, one row per haul; only what they need is computed."""
    return sample_metrics(counts, sentinel, wanted=names).select("Reference", *names)
