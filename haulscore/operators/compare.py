"""Differences between two tables with the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..runtime import lookup_join, settle

# Key buckets whose checksums are compared before any row is moved.
DIGEST_BUCKETS = 4096


def table_digests(frame: DataFrame, key: str, columns: Sequence[str], buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """(bucket, n, sums): for each bucket of keys the number of rows and a checksum of them that does not depend on their order.

    The checksum is the exact sums of two hashes of 64 bits with different seeds. Equal rows have equal checksums; of different ones a pair in about 2^100 has.
    A row leaves its task only as part of a bucket's sums.
    """
    # Type names keep columns of different types apart; equal values of different types are left to the rows themselves.
    values = [F.col(c) for c in (key, *columns)]
    missing = [F.col(c).isNull() for c in (key, *columns)]
    kinds = F.lit(",".join(frame.schema[c].dataType.simpleString() for c in columns))
    hashes = [F.xxhash64(F.lit(seed), kinds, *values, *missing).cast("decimal(20,0)") for seed in (1, 2)]
    return frame.select(bucket_of(F.col(key), buckets).alias("bucket"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.array(F.sum("h0"), F.sum("h1")).alias("sums")
    )


def bucket_of(key: Column, buckets: int = DIGEST_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def compare_by_digests(
    a: DataFrame, b: DataFrame, key: str = "Reference", tol: float = 0.1, columns: Sequence[str] | None = None, buckets: int = DIGEST_BUCKETS
) -> DataFrame:
    """The rows of ``compare_tables``, moving only the rows of key buckets whose checksums differ.

    Both tables are read for their checksums and again for the differing buckets, so give it scans or settled frames. The key must have one type.
    """
    shared = [c for c in (columns or a.columns) if c != key and c in a.columns and c in b.columns]
    if not shared:
        return compare_tables(a, b, key, tol, columns)
    left, right = (table_digests(frame, key, shared, buckets) for frame in (a, b))
    same = left.alias("l").join(right.alias("r"), "bucket", "full").select("bucket", (F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.sums").eqNullSafe(F.col("r.sums"))).alias("same"))
    differing = settle(same.where(~F.col("same")).select("bucket"), "differing-buckets")

    def kept(frame: DataFrame) -> DataFrame:
        return lookup_join(frame.withColumn("_bucket", bucket_of(F.col(key), buckets)), differing.withColumnRenamed("bucket", "_bucket"), ["_bucket"], "inner").select(*frame.columns)

    return compare_tables(kept(a), kept(b), key, tol, columns)


def compare_tables(
    a: DataFrame, b: DataFrame, key: str = "Reference", tol: float = 0.1, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and column whose values differ, one per key that only one table has (``only_a``, ``only_b``),
    and one per column that only one table has (``column_only_a``, ``column_only_b``, without a key).

    Numbers differ when they are more than ``tol`` apart; text when unequal; a missing value differs from
    a present one. Where one table has numbers and the other text, text that is no number differs from any. Missing keys match each
    other. The key is unique in each table, so the full join is one to one.
    """
    wanted = [c for c in (columns or dict.fromkeys([*a.columns, *b.columns])) if c != key]
    shared = [c for c in wanted if c in a.columns and c in b.columns]
    types = {f"{side}.{f.name}": f.dataType for side, frame in (("a", a), ("b", b)) for f in frame.schema}
    left = a.select(F.col(key).alias("_a_key"), F.lit(True).alias("_in_a"), F.struct(F.lit(1).alias("_"), *shared).alias("a"))
    right = b.select(F.col(key).alias("_b_key"), F.lit(True).alias("_in_b"), F.struct(F.lit(1).alias("_"), *shared).alias("b"))
    joined = left.join(right, F.col("_a_key").eqNullSafe(F.col("_b_key")), "full").withColumn(
        "status",
        F.when(F.col("_in_b").isNull(), "only_a").when(F.col("_in_a").isNull(), "only_b").otherwise("differs"),
    )

    def number(value: Column) -> Column:
        return value.try_cast("double")

    found = []
    for name in shared:
        va, vb = F.col(f"a.{name}"), F.col(f"b.{name}")
        if any(isinstance(types[f"{side}.{name}"], NumericType) for side in "ab"):
            na, nb = number(va), number(vb)
            gap = F.abs(na - nb)
            unread = (va.isNotNull() & na.isNull()) | (vb.isNotNull() & nb.isNull())
            differs = (gap > tol) | (va.isNull() != vb.isNull()) | unread
        else:
            gap = F.lit(None).cast("double")
            differs = ~va.cast("string").eqNullSafe(vb.cast("string"))
        found.append(
            F.when(
                (F.col("status") == "differs") & F.coalesce(differs, F.lit(False)),
                F.struct(
                    F.lit(name).alias("column"),
                    va.cast("string").alias("value_a"),
                    vb.cast("string").alias("value_b"),
                    gap.alias("difference"),
                ),
            )
        )
    nothing = [F.lit(None).cast("string").alias(c) for c in ("column", "value_a", "value_b")]
    lone = F.when(F.col("status") != "differs", F.struct(*nothing, F.lit(None).cast("double").alias("difference")))
    rows = F.explode(F.filter(F.array(*found, lone), lambda r: r.isNotNull()))
    out = joined.select(F.coalesce("_a_key", "_b_key").alias(key), "status", rows.alias("r")).select(key, "status", "r.*")
    lone_columns = [(c, "column_only_a" if c in a.columns else "column_only_b") for c in wanted if (c in a.columns) != (c in b.columns)]
    if not lone_columns:
        return out
    listed = a.sparkSession.createDataFrame(lone_columns, "column string, status string")
    return out.unionByName(listed, allowMissingColumns=True)
