"""Scans. All of them are lazy and typed; filters and column lists reach the source through Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.expressions import segment_name


def _keep_blanks(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A blank cell is a value of its own for class codes; the CSV reader makes it NULL."""
    return frame.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


def read_csv(
    spark: SparkSession, path: str, schema: StructType, blank_is_value: tuple[str, ...] = (), whole_text: bool = False, **options: str
) -> DataFrame:
    """CSV with a header, doubled quotes inside quoted text, and ``NA`` for missing values.

    The schema applies by position. Name in ``blank_is_value`` the text columns where an empty cell
    is not a missing one. ``whole_text`` reads what ``write_csv`` wrote with that option. Line breaks inside quotes need whole files (``multiLine``), a task
    each, so write as many files as tasks are wanted; without the option a file is split and a line is a row.
    """
    settings = {"header": "true", "escape": '"', "encoding": "UTF-8"}
    if whole_text:
        settings |= {"multiLine": "true", "nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    settings |= options
    text = [f.name for f in schema if isinstance(f.dataType, StringType)]
    frame = spark.read.schema(schema).options(**settings).option("nullValue", settings.get("nullValue", "NA")).csv(path)
    unknown = set(blank_is_value) - set(text)
    if unknown:
        raise ValueError(f"not text columns of the schema: {sorted(unknown)}")
    return _keep_blanks(frame, blank_is_value)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A stored table (Parquet, ORC); with a schema only its columns are read."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_jdbc(spark: SparkSession, columns: list[str], **options: str) -> DataFrame:
    """A database table through Spark's JDBC source.

    All connection options come from the caller. For a large table give partitionColumn, lowerBound,
    upperBound and numPartitions, else one task reads it all.
    """
    return spark.read.format("jdbc").options(**options).load().select(*columns)


def segments_from_vertices(vertices: DataFrame) -> DataFrame:
    """(segment_code, ring_no, vertex_no, x, y) rows to one row per polygon with its closed rings."""
    point = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rings = vertices.groupBy("segment_code", "ring_no").agg(
        F.sort_array(F.collect_list(F.struct("vertex_no", point.alias("point")))).alias("ordered")
    )
    ring = F.transform("ordered", lambda v: v["point"])
    return (
        rings.select("segment_code", "ring_no", ring.alias("ring"))
        .groupBy("segment_code")
        .agg(F.sort_array(F.collect_list(F.struct("ring_no", "ring"))).alias("numbered"))
        .select(
            F.col("segment_code").cast("int").alias("segment_code"),
            segment_name(F.col("segment_code")).alias("bay_segment"),
            F.transform("numbered", lambda r: r["ring"]).alias("rings"),
        )
    )


def segments_from_wkt(layer: DataFrame) -> DataFrame:
    """(segment_code, wkt) rows with POLYGON or MULTIPOLYGON text to the segment table."""

    def point(text):
        ordinates = F.split(F.trim(text), r"\s+")
        return F.struct(ordinates[0].cast("double").alias("x"), ordinates[1].cast("double").alias("y"))

    rings = F.transform(
        F.regexp_extract_all("wkt", F.lit(r"\(([^()]+)\)"), F.lit(1)),
        lambda ring: F.transform(F.split(ring, ","), point),
    )
    return layer.select(
        F.col("segment_code").cast("int").alias("segment_code"),
        segment_name(F.col("segment_code")).alias("bay_segment"),
        rings.alias("rings"),
    )
