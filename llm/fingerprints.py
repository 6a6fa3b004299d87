"""Threshold-scaled sketches of word shingles, in built-in functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever a document's length, so sketches
merge by union and tell containment between very unequal documents. Texts too short to leave ``FLOOR`` such hashes
keep their ``FLOOR`` least hashes instead; these merge the same way.

Null and empty texts have the empty sketch. A text of fewer words than a shingle counts as one shingle. Two empty
sketches are alike (1.0), an empty and another are not (0.0). Repeated rows have equal sketches; an empty table stays empty. A text of any length is sketched
whole: its words and shingle hashes are held. Other columns stay; one named like the added column is replaced, and names that
begin with an underscore are the module's own.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import once, words

SHINGLE_WORDS = 5
# The share of all hashes that a sketch retains, as a power of two: 2 ** -SCALE_BITS.
SCALE_BITS = 3
FLOOR = 16


def threshold(scale_bits: int = SCALE_BITS) -> int:
    """Hashes h, as unsigned numbers, with h < 2 ** (64 - scale_bits) are retained; two bits or more keep them positive."""
    if not 1 <= scale_bits <= 32:
        raise ValueError("scale_bits must be 1 to 32")
    return 1 << (64 - scale_bits)


def _retained(h: Column, scale_bits: int) -> Column:
    return (h >= 0) if scale_bits == 1 else (h >= 0) & (h < threshold(scale_bits))


def _unsigned(h: Column) -> Column:
    """Signed numbers in the order of the unsigned ones."""
    return h.bitwiseXOR(F.lit(-(1 << 63)))


def with_sketch(docs: DataFrame, text: str, out: str, n: int = SHINGLE_WORDS, scale_bits: int = SCALE_BITS, floor: int = FLOOR) -> DataFrame:
    """Add ``out``, the sorted distinct retained shingle hashes of column ``text`` as array<bigint>."""
    tokens, hashes, kept = F.col(f"_{out}_t"), F.col(f"_{out}_h"), F.col(f"_{out}_k")
    shingles = (
        F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.xxhash64(F.slice(tokens, i, n))))
        .when(F.size(tokens) > 0, F.array(F.xxhash64(tokens)))
        .otherwise(F.array().cast("array<bigint>"))
    )
    least = F.transform(
        F.slice(F.sort_array(F.transform(F.array_distinct(hashes), _unsigned)), 1, floor), _unsigned
    )
    return (
        docs.withColumn(f"_{out}_t", words(F.col(text)))
        .withColumn(f"_{out}_h", shingles)
        .withColumn(f"_{out}_k", F.array_distinct(F.filter(hashes, lambda h: _retained(h, scale_bits))))
        .withColumn(out, once(F.when(F.size(kept) >= floor, F.sort_array(kept)).otherwise(least)))
        .drop(f"_{out}_t", f"_{out}_h", f"_{out}_k")
    )


def _shared(a: Column, b: Column, scale_bits: int, floor: int) -> tuple[Column, Column, Column, Column]:
    """Hashes that both sketches know about: retained ones, or the least of the union where these are too few."""
    union = F.array_union(a, b)
    retained = F.filter(union, lambda h: _retained(h, scale_bits))
    least = F.transform(F.slice(F.sort_array(F.transform(union, _unsigned)), 1, floor), _unsigned)
    seen = F.when(F.size(retained) >= floor, retained).otherwise(least)
    both = F.size(F.array_intersect(F.array_intersect(a, b), seen))
    return F.size(seen), both, F.size(F.array_intersect(a, seen)), F.size(F.array_intersect(b, seen))


def likeness(a: Column, b: Column, scale_bits: int = SCALE_BITS, floor: int = FLOOR) -> Column:
    """Estimated Jaccard likeness of the shingle sets behind two sketches, 0 to 1. Equal sketches give 1."""
    total, both, _, _ = _shared(a, b, scale_bits, floor)
    return F.when(a == b, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / total)


def containment(a: Column, b: Column, scale_bits: int = SCALE_BITS, floor: int = FLOOR) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` holds as well, 0 to 1. An empty sketch is contained in any."""
    _, both, in_a, _ = _shared(a, b, scale_bits, floor)
    return F.when(F.size(a) == 0, 1.0).when(F.size(b) == 0, 0.0).otherwise(F.coalesce(F.try_divide(both, in_a), F.lit(0.0)))


def merge(a: Column, b: Column, scale_bits: int = SCALE_BITS, floor: int = FLOOR) -> Column:
    """The sketch of two documents' shingles together."""
    union = F.array_union(a, b)
    retained = F.filter(union, lambda h: _retained(h, scale_bits))
    least = F.transform(F.slice(F.sort_array(F.transform(union, _unsigned)), 1, floor), _unsigned)
    return F.when(F.size(retained) >= floor, F.sort_array(retained)).otherwise(least)


def to_text(sketch: Column) -> Column:
    """A sketch as text: its hashes in their order, 16 lower-case hex digits each."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, key: str, text: str, out: str, buckets: int | None = None, prepare=lambda frame: frame, also: dict[str, str] | None = None) -> DataFrame:
    """Add ``out``, the text of the next document by ascending key; the last one's next is the first.

    Keys are cut into ranges of about equal row counts, a few for each shuffle partition; the first document of each range
    is also sent to the range before it, so each range finds all its successors alone. ``prepare`` runs after the shuffle and may add
    columns; ``also`` names such columns to take from the next document (new name: column). Rows of one key
    follow each other by text; a null key comes first, a null text is empty.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.withColumn("_key", order).withColumn("_place", F.col("_key").cast("double"))
    cuts = keyed.select("_place").agg(F.percentile_approx("_place", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] if buckets > 1 else []
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    # Whole numbers: a window over a float key would shuffle anew.
    if len(splits) > 2:
        keyed = Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket").transform(keyed).withColumn("_bucket", F.col("_bucket").cast("int"))
    else:
        keyed = keyed.withColumn("_bucket", F.lit(0))
    # One row for each range: its least key, and the range before it (the last one's successor is the first range).
    firsts = keyed.groupBy("_bucket").agg(F.min("_key").alias("_key"))
    before = Window.orderBy("_bucket")
    firsts = firsts.withColumn("_before", F.lag("_bucket").over(before)).withColumn("_last", F.max("_bucket").over(Window.partitionBy(F.lit(0))))
    firsts = firsts.select("_key", F.coalesce("_before", "_last").alias("_before"), F.col("_before").isNull().alias("_wraps"))
    home = F.struct(F.col("_bucket").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("_before").alias("range"), F.lit(1).alias("guest"))
    dealt = (
        keyed.join(F.broadcast(firsts), "_key", "left")
        .withColumn("_at", F.explode(F.when(F.col("_before").isNull(), F.array(home)).otherwise(F.array(home, guest))))
        .withColumn("_range", F.col("_at.range"))
        .withColumn("_guest", F.col("_at.guest"))
        .withColumn(text, F.coalesce(F.col(text), F.lit("")))
        .drop("_at", "_before", "_wraps", "_bucket", "_place")
        .repartition("_range")
    )
    run = Window.partitionBy("_range").orderBy("_guest", "_key", text)
    found = prepare(dealt)
    for name, column in {out: text, **(also or {})}.items():
        found = found.withColumn(name, F.lead(column).over(run))
    return found.where("_guest = 0").drop("_range", "_guest", "_key")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as many first characters of the following one (or all of it)."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))
