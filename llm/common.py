"""What the operators of this package share: input columns, settled tables, Arrow buffers, and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulscore.runtime import shared_folder

# White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Releases the shuffle files of a step once its result is written.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other step uses."""
    return f"{shared_folder(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and go on from the written table: a lost executor costs a re-read."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(frame.schema).parquet(path)


def forget(spark: SparkSession, frame: DataFrame) -> None:
    """Delete a settled table that no later step reads."""
    for file in {name.rpartition("/")[0] for name in frame.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, split at white space; a null or empty text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def once(value: Column) -> Column:
    """The value, computed once a row: a filter on it is not pushed below, where its parts would be worked out again and again."""
    return F.explode(F.array(value))


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array, and where each begins (one more: the end). Null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text stands alone."""
    begin, n = 0, len(starts) - 1
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + most, side="right")) - 1)
        yield begin, end
        begin = end


def with_arrow(
    docs: DataFrame, text: str, fields: Sequence[T.StructField], compute: Callable[[pa.RecordBatch], Sequence[pa.Array]], most: int = 2 << 20, drop: Sequence[str] = ()
) -> DataFrame:
    """Add columns that ``compute`` makes of Arrow batches of about ``most`` bytes of text; the others pass through as they are.

    ``drop`` names columns that ``compute`` reads but the result leaves out. Columns that clash with the added ones are replaced.
    """
    docs = docs.drop(*(field.name for field in fields))
    kept = [field for field in docs.schema.fields if field.name not in drop]
    schema = T.StructType([*kept, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, starts = text_bytes(batch.column(text))
            for first, last in slices(starts, most):
                part = batch.slice(first, last - first)
                columns = [part.column(field.name) for field in kept] + list(compute(part))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components: (a, b) links of long node ids to (node, component), component the smallest node reachable.

    Alternates the large-star and small-star steps of Kiveris and others (2014), each an aggregate combined before
    its shuffle and an equi-join, so that a hub's links spread. Every round is settled; rounds grow with the
    logarithm of the longest chain. Only nodes that have a link come back.
    """
    spark = edges.sparkSession
    links = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-links"
    )
    while True:
        # Large star: every neighbour above a node is tied to the least node around it.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every neighbour below a node, and the node, are tied to the least of them.
        large = settle(large, f"{name}-large")
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("s"))
            .select("s.a", "s.b")
            .where("a <> b")
            .distinct()
        )
        after = settle(small, f"{name}-small")
        # Done once the links are stars: no node is both a member and a centre, and no member has two centres.
        bad = after.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            after.select(F.col("b"), F.lit(0), F.lit(1))
        )
        open_nodes = bad.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
        forget(spark, links)
        forget(spark, large)
        links = after
        if open_nodes.isEmpty():
            break
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
