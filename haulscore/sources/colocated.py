"""Hauls and records stored side by side, so that they are joined where they lie.

Both tables are bucketed by the haul's reference: equal references are in equally numbered files, and a join or a sum by reference reads a pair of
files in each task and shuffles nothing, year after year. A bucket cannot be split, so hauls of very many records are
stored apart: their records in plain files of any number, the few hauls beside them, small enough to be broadcast. An operator is
applied to both parts and its rows are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import lookup_join, settle

# A haul with more records is stored apart.
HOT_RECORDS = 1_000_000
PARTS = ("hauls", "records", "hot_hauls", "hot_records")


@dataclass(frozen=True)
class Colocated:
    """The stored tables. ``hauls`` and ``records`` are bucketed alike."""

    hauls: DataFrame
    records: DataFrame
    hot_hauls: DataFrame
    hot_records: DataFrame

    def apply(self, operator: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``operator(hauls, records)`` on both parts. It must treat each haul by itself."""
        whole = operator(self.hauls, self.records)
        if self.hot_hauls.isEmpty():
            return whole
        return whole.unionByName(operator(F.broadcast(self.hot_hauls), self.hot_records))


def write_colocated(hauls: DataFrame, records: DataFrame, folder: str, buckets: int, key: str = "Reference", hot_records: int = HOT_RECORDS) -> None:
    """Store both tables under ``folder``. Rows without a key are stored apart too.

    Each bucket is one file, so ``buckets`` should give files of some hundred MB of records. Hauls of more than ``hot_records`` records
    are at most the number of records over that; they, and the reference of each, are what is broadcast.
    """
    many = records.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_records")).where(F.col("_records") > hot_records)
    hot = settle(many, "hot-hauls")

    def divided(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = lookup_join(frame, hot, [key], "left")
        apart = F.col("_records").isNotNull() | F.col(key).isNull()
        return marked.where(~apart).drop("_records"), marked.where(apart).drop("_records")

    for name, frame in (("hauls", hauls), ("records", records)):
        usual, large = divided(frame)
        table = _table_name(folder, name)
        # The shuffle deals rows as buckets do: one task and one file for each bucket.
        usual.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").saveAsTable(table)
        large.write.parquet(f"{folder}/hot_{name}")


def _table_name(folder: str, name: str) -> str:
    """A name of the path's own: buckets are known to Spark by a table, not by a folder."""
    return f"colocated_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def open_colocated(spark: SparkSession, folder: str, buckets: int, key: str = "Reference") -> Colocated:
    """The tables that ``write_colocated`` has stored, also in another session.

    A join uses the buckets if the key alone is its key: test further columns as conditions.
    """
    found = {}
    for name in PARTS:
        path = f"{folder}/{name}"
        plain = spark.read.parquet(path)
        if name.startswith("hot_"):
            found[name] = plain
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
        table = _table_name(folder, name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        found[name] = spark.table(table)
    return Colocated(**found)
