"""Running sums inside groups of any size.

A window holds a group in one task. Here the rows are range-partitioned by (group, rank value), so a large group lies in many blocks, one after
another. Each block's sums are one small row for each group it holds; added up over the blocks before, they are what a block's own
running sums start from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import lookup_join, settle

# Rows of a block, about: ranges come from a sample.
BLOCK_ROWS = 100_000


def running_sums(frame: DataFrame, key: str, by: str, amounts: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``<amount>_through``, the running sum with the row itself, largest ``by`` first, and ``<amount>_total`` of the key.

    Rows of equal ``by`` follow in any order, but lie in one block. NULL amounts add nothing; a key or rank value may be NULL.
    ``frame`` is read twice, so give it a scan or a settled frame. Tasks that are run again read the written blocks, so the blocks stay as they are.
    """
    blocks = -(-frame.count() // block_rows) or 1
    placed = frame.repartitionByRange(blocks, F.col(key), F.desc(by)).withColumn("_block", F.spark_partition_id())
    placed = settle(placed, "blocks")
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = placed.groupBy(key, "_block").agg(*[F.sum(a).alias(a) for a in amounts])
    starts = sums.select(
        key,
        "_block",
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_{a}_before") for a in amounts],
        *[F.sum(a).over(whole).alias(f"{a}_total") for a in amounts],
    )
    met = lookup_join(placed, settle(starts, "block-sums"), [key, "_block"], "inner", null_safe=True)
    here = Window.partitionBy(key, "_block").orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return met.select(
        *frame.columns,
        *[(F.col(f"_{a}_before") + F.coalesce(F.sum(a).over(here), F.lit(0))).alias(f"{a}_through") for a in amounts],
        *[f"{a}_total" for a in amounts],
    )
