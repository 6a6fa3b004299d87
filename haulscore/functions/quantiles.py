"""Exact quantiles (linear interpolation at position (n-1)p) that never gather a large group in one task.

Where every group is measured to be small, the built-in aggregate does. Beyond that:

1. A mergeable sketch per group brackets each wanted rank: the exact value lies between two sketch values
   whose ranks differ by a small fraction of the group.
2. One pass of plain sums counts the values below each bracket and up to its end, which proves the bracket.
   A proven bracket of one value is the answer already, as it mostly is for counts.
3. Values inside the other brackets are counted by value (combined before the shuffle, so repeated values
   collapse) and the few that remain are ranked.

Both ways give the same bits: equal neighbours are returned as they are, others are weighted as the built-in
aggregate weights them, and NaN ranks last.

A bracket that step 2 does not prove is widened to the whole group, so the result is exact in any case.
That happens only to groups of fewer than about 20,000 rows: beyond it the sketch's error bound is smaller than
the reach of the bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import lookup_join, settle

# Sketch accuracy: ranks are right to 1/ACCURACY of the group, and a bracket reaches twice as far.
ACCURACY = 10_000
REACH = 2.0 / ACCURACY
# Groups up to this many rows may each be held in one task's memory.
SMALL_GROUP = 200_000


def prob_label(prob: float) -> str:
    return f"P{prob * 100:g}"


def _attach(frame: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put each row's group values beside it; without groups they are those of the only row."""
    if by:
        return lookup_join(frame, small, by, "inner", null_safe=True)
    row = small.first() or dict.fromkeys(small.columns)
    return frame.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in small.schema})


def exact_quantiles(
    frame: DataFrame, by: Sequence[str], values: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """One row per group with a column ``<value>_P<100p>`` per value and probability; NULLs are skipped.

    ``frame`` is read up to four times: give it a scan or a settled frame.
    """
    largest = frame.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= SMALL_GROUP:
        # One call per value: its probabilities share one table of counted values.
        shares = F.array(*[F.lit(p) for p in probs])
        found = frame.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), shares).alias(c) for c in values])
        labels = [prob_label(p) for p in probs]
        return found.select(*by, *[F.col(c)[i].alias(f"{c}_{label}") for c in values for i, label in enumerate(labels)])
    return _bracketed(frame, list(by), list(values), list(probs))


def _bracketed(frame: DataFrame, by: list[str], values: list[str], probs: list[float]) -> DataFrame:
    keys = [f"`{c}`" for c in by]
    columns = range(len(values))
    wanted = [(v, i) for v in columns for i in range(len(probs))]
    data = frame.selectExpr(*keys, *[f"CAST(`{c}` AS DOUBLE) AS v{v}" for v, c in enumerate(values)])

    ends = ", ".join(f"{max(p - REACH, 0.0)}D, {min(p + REACH, 1.0)}D" for p in probs)
    sketch = data.groupBy(*by).agg(
        *[F.expr(f"count(v{v})").alias(f"n{v}") for v in columns],
        *[F.expr(f"percentile_approx(v{v}, array({ends}), {ACCURACY})").alias(f"ends{v}") for v in columns],
    )
    brackets = settle(
        sketch.selectExpr(
            *keys,
            *[f"n{v}" for v in columns],
            *[f"ends{v}[{2 * i}] AS low{v}_{i}" for v, i in wanted],
            *[f"ends{v}[{2 * i + 1}] AS high{v}_{i}" for v, i in wanted],
        ),
        "quantile-brackets",
    )

    counted = (
        _attach(data, brackets, by)
        .groupBy(*brackets.columns)
        .agg(
            *[F.expr(f"count_if(v{v} < low{v}_{i})").alias(f"below{v}_{i}") for v, i in wanted],
            *[F.expr(f"count_if(v{v} <= high{v}_{i})").alias(f"upto{v}_{i}") for v, i in wanted],
        )
    )
    ranked = counted.selectExpr(
        "*",
        *[f"(n{v} - 1) * {probs[i]}D AS position{v}_{i}" for v, i in wanted],
        *[f"floor((n{v} - 1) * {probs[i]}D) AS rank{v}_{i}" for v, i in wanted],
    )
    proven = ranked.selectExpr(
        "*",
        *[
            f"below{v}_{i} <= rank{v}_{i} AND upto{v}_{i} > least(rank{v}_{i} + 1, n{v} - 1) AS holds{v}_{i}"
            for v, i in wanted
        ],
    )
    # One struct per bracket that still has to be searched; NULL where its value is known.
    plan = settle(
        proven.selectExpr(
            *keys,
            *[f"IF(holds{v}_{i} AND low{v}_{i} = high{v}_{i}, low{v}_{i}, NULL) AS known{v}_{i}" for v, i in wanted],
            *[
                f"CASE WHEN holds{v}_{i} AND low{v}_{i} = high{v}_{i} THEN NULL "
                f"WHEN holds{v}_{i} THEN low{v}_{i} ELSE CAST('-Infinity' AS DOUBLE) END AS low{v}_{i}"
                for v, i in wanted
            ],
            *[f"IF(holds{v}_{i}, high{v}_{i}, CAST('NaN' AS DOUBLE)) AS high{v}_{i}" for v, i in wanted],
            *[f"IF(holds{v}_{i}, below{v}_{i}, 0L) AS base{v}_{i}" for v, i in wanted],
            *[f"position{v}_{i}" for v, i in wanted],
        ),
        "quantile-ranks",
    )

    searched = {(v, i): f"v{v} BETWEEN low{v}_{i} AND high{v}_{i}" for v, i in wanted}
    candidates = ", ".join(
        f"IF({test}, named_struct('v', {v}, 'i', {i}, 'value', v{v}, 'base', base{v}_{i}, 'position', position{v}_{i}), NULL)"
        for (v, i), test in searched.items()
    )
    inside = (
        _attach(data, plan, by)
        .filter(" OR ".join(f"coalesce({test}, false)" for test in searched.values()))
        .selectExpr(*keys, f"inline(filter(array({candidates}), c -> c IS NOT NULL))")
        .groupBy(*by, "v", "i", "value", "base", "position")
        .agg(F.expr("count(1)").alias("copies"))
    )
    group = ", ".join([*keys, "v", "i"])
    placed = inside.selectExpr(
        *keys,
        "v",
        "i",
        "value",
        "position",
        "floor(position) AS rank",
        "copies",
        f"base + sum(copies) OVER (PARTITION BY {group} ORDER BY value ROWS UNBOUNDED PRECEDING) AS stop",
    )
    found = (
        placed.groupBy(*by, "v", "i")
        .agg(
            F.expr("max(IF(rank >= stop - copies AND rank < stop, value, NULL))").alias("lower"),
            F.expr("max(IF(rank + 1 >= stop - copies AND rank + 1 < stop, value, NULL))").alias("upper"),
            F.expr("max(position)").alias("position"),
            F.expr("max(rank)").alias("rank"),
        )
        .selectExpr(
            *keys,
            "v",
            "i",
            "IF(position = rank OR lower = upper, lower, (rank + 1 - position) * lower + (position - rank) * upper) AS value",
        )
    )
    known = ", ".join(f"named_struct('v', {v}, 'i', {i}, 'value', known{v}_{i})" for v, i in wanted)
    return (
        found.unionByName(plan.selectExpr(*keys, f"inline(array({known}))"))
        .groupBy(*by)
        .agg(
            *[
                F.expr(f"max(IF(v = {v} AND i = {i}, value, NULL))").alias(f"{values[v]}_{prob_label(probs[i])}")
                for v, i in wanted
            ]
        )
    )
