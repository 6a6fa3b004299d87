"""Survey tables derived from the given tables: an order is a haul, its lines are catch records, a customer is
a site and a part a species. Orders without lines are hauls without fish, or without gear set.

Whole tables only: all species, sites, hauls and records take part at every scale.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulscore.plans import IndexSettings, SurveyTables
from haulscore.runtime import lookup_join
from haulscore.sources import read_table, segments_from_vertices, segments_from_wkt

REFERENCE_YEARS = (1996, 1999)
SINCE = "1995-01-01"
SENTINEL = "Species 0"
MAP_YEAR = 1999
SETTINGS = IndexSettings(
    since=SINCE, sentinel=SENTINEL, reference_years=REFERENCE_YEARS
)

# Segment polygons over the sites' coordinates (segment, vertex, x, y).
VERTICES = [
    (1, 1, -0.05, -0.05), (1, 2, 3.05, -0.05), (1, 3, 3.05, 4.05), (1, 4, -0.05, 4.05), (1, 5, -0.05, -0.05),
    (2, 1, 3.05, -0.05), (2, 2, 6.05, -0.05), (2, 3, 5.05, 4.05), (2, 4, 3.05, 4.05), (2, 5, 3.05, -0.05),
    (3, 1, -0.05, 4.05), (3, 2, 5.05, 4.05), (3, 3, 5.05, 6.05), (3, 4, 2.55, 6.05), (3, 5, 2.55, 5.05),
    (3, 6, -0.05, 5.05), (3, 7, -0.05, 4.05),
    (4, 1, -0.05, 6.05), (4, 2, 6.05, 6.05), (4, 3, 6.05, 9.65), (4, 4, -0.05, 9.65), (4, 5, -0.05, 6.05),
    (5, 1, 6.05, 6.05), (5, 2, 8.25, 6.05), (5, 3, 8.25, 9.65), (5, 4, 6.05, 9.65), (5, 5, 6.05, 6.05),
    (6, 1, 5.05, 4.05), (6, 2, 7.05, 4.05), (6, 3, 7.05, 6.05), (6, 4, 5.05, 6.05), (6, 5, 5.05, 4.05),
    (7, 1, 7.05, -0.05), (7, 2, 8.25, -0.05), (7, 3, 8.25, 4.05), (7, 4, 7.05, 4.05), (7, 5, 7.05, -0.05),
]


def _reference(order_key: Column) -> Column:
    bay = F.when(order_key % 13 == 0, "CKM").otherwise("TBM")
    return F.concat(bay, F.lpad(order_key.cast("string"), 10, "0"))


def _species_code(part_key: Column) -> Column:
    return (F.lit(8800000000) + part_key * 100 + 1).cast("string")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, f"{sf_dir}/customer.parquet").select(
        key.alias("o_custkey"),
        ((key % 83).cast("double") / 10).alias("Longitude"),
        ((key % 97).cast("double") / 10).alias("Latitude"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("Zone"),
        (key % 170 + 200).cast("int").alias("Grid"),
    )


def physical(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return lookup_join(orders, sites(spark, sf_dir), ["o_custkey"], "inner").select(
        _reference(key).alias("Reference"),
        F.col("o_orderdate").alias("Sampling_Date"),
        F.when(key % 5 == 0, "XX").otherwise("AM").alias("Project_1"),
        F.when(key % 10 == 0, "AM").alias("Project_2"),
        F.lit(None).cast("string").alias("Project_3"),
        F.when(key % 7 == 0, "23").when(key % 2 == 0, "19").otherwise("20").alias("Gear"),
        "Longitude",
        "Latitude",
        "Zone",
        "Grid",
        F.when(key % 3 == 0, "A").otherwise("B").alias("Stratum"),
    )


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    records = lines.select(
        _reference(F.col("l_orderkey")).alias("Reference"),
        line.cast("int").alias("Species_record_id"),
        F.when(line == 4, "2").when(line == 5, "").when(line == 6, "N").alias("Splittype"),
        F.when(line == 4, (F.col("l_quantity").cast("int") % 3 + 1).cast("string")).alias("Splitlevel"),
        F.lit(1).alias("Cells"),
        _species_code(F.col("l_partkey")).alias("NODCCODE"),
        F.col("l_quantity").cast("int").alias("Number"),
        F.when((line == 7) & (F.col("l_returnflag") == "R"), "D")
        .when((line == 7) & (F.col("l_returnflag") == "A"), None)
        .otherwise("F")
        .alias("FHC"),
    )
    key = F.col("o_orderkey")
    fished = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    orders = read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey")
    empty = orders.join(fished, "o_orderkey", "left_anti").select(
        _reference(key).alias("Reference"),
        F.lit(1).alias("Species_record_id"),
        F.lit(None).cast("string").alias("Splittype"),
        F.lit(None).cast("string").alias("Splitlevel"),
        F.lit(1).alias("Cells"),
        F.when(key % 17 == 0, "9999000000").otherwise("9998000000").alias("NODCCODE"),
        F.lit(0).alias("Number"),
        F.lit("F").alias("FHC"),
    )
    return records.unionByName(empty)


def species(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    parts = read_table(spark, f"{sf_dir}/part.parquet").select(
        (key + 100000).cast("int").alias("TSN"),
        _species_code(key).alias("NODCCODE"),
        F.concat(F.lit("Species "), key.cast("string")).alias("ScientificName"),
        F.concat(F.lit("Common "), key.cast("string")).alias("Commonname"),
        F.when(key % 10 == 9, "N").otherwise("Y").alias("Include_Index"),
        F.when(size % 4 == 0, "P").otherwise("B").alias("Hab_Cat"),
        F.when(key % 13 == 0, "").when(size % 3 == 0, "ES").when(size % 7 == 0, "FS").otherwise("MS").alias("Est_Cat"),
        F.when(key % 3 == 0, "S").when(key % 5 == 0, "F").otherwise("O").alias("Est_Use"),
        F.when(size % 5 == 0, "TG").otherwise("TS").alias("Feeding_Cat"),
        F.when(key % 29 == 7, "")
        .when(F.col("p_type") == "STANDARD", "ZB")
        .when(F.col("p_type") == "ECONOMY", "PV")
        .when(F.col("p_type") == "MEDIUM", "ZP")
        .when(F.col("p_type") == "PROMO", "OV")
        .when(F.col("p_type") == "SMALL", "HV")
        .otherwise("DV")
        .alias("Feeding_Guild"),
        F.when(key % 4 == 0, "Y").otherwise("N").alias("Selected_Taxa"),
    )
    special = spark.sql(
        "SELECT * FROM VALUES (9998, '9998000000', 'No fish', 'No fish', 'Y', '.', '.', '.', '.', '.', 'N'), "
        f"(9999, '9999000000', 'No gear set', 'No gear set', 'N', '.', '.', '.', '.', '.', 'N') AS t({', '.join(parts.columns)})"
    )
    return parts.unionByName(special)


def segments(spark: SparkSession) -> DataFrame:
    vertices = spark.createDataFrame(
        [(code, 1, number, x, y) for code, number, x, y in VERTICES],
        "segment_code int, ring_no int, vertex_no int, x double, y double",
    )
    return segments_from_vertices(vertices)


def survey(spark: SparkSession, sf_dir: str) -> SurveyTables:
    classed = species(spark, sf_dir)
    return SurveyTables(
        physical=physical(spark, sf_dir),
        numbers=numbers(spark, sf_dir),
        species_list=classed.select("NODCCODE", F.col("ScientificName").alias("Scientificname"), "Commonname"),
        species=classed,
        segments=segments(spark),
    )


def damaged_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with a fifth of their species codes in scientific notation."""
    code = F.col("NODCCODE")
    scientific = F.concat(F.substring(code, 1, 1), F.lit("."), F.substring(code, 2, 9), F.lit("e+09"))
    return numbers(spark, sf_dir).withColumn("NODCCODE", F.when(F.col("Number") % 5 == 0, scientific).otherwise(code))


def flawed_catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of all hauls with their attributes and every kind of flaw that the report looks for."""
    line, part, order = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_orderkey")
    records = read_table(spark, f"{sf_dir}/lineitem.parquet").select(
        F.when((line != 1) | (order % 101 != 0), _reference(order)).alias("Reference"),
        _reference(order).alias("of_haul"),
        F.when((line == 1) & (part % 70 == 3), None)
        .when(part % 60 == 7, F.concat(F.lit("77"), part.cast("string")))
        .when((line == 1) & (order % 43 == 0), "9998000000")
        .otherwise(_species_code(part))
        .alias("NODCCODE"),
        F.when(line == 4, "2").alias("Splittype"),
        F.when((line == 4) & (part % 30 != 0), "1").alias("Splitlevel"),
        F.when((line == 3) & (part % 50 == 0), None)
        .when((line == 2) & (part % 40 == 1), 0)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("Number"),
        ((line == 2) & (order % 37 == 0)).alias("moved"),
    )
    hauls = physical(spark, sf_dir).select(F.col("Reference").alias("of_haul"), "Sampling_Date", "Longitude", "Latitude", "Zone", "Grid")
    joined = records.join(hauls, "of_haul", "inner")
    return joined.withColumn("Zone", F.when(F.col("moved"), "ELSEWHERE").otherwise(F.col("Zone"))).drop("of_haul", "moved")


def species_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class table with some codes twice."""
    classed = species(spark, sf_dir)
    return classed.unionByName(classed.filter((F.col("TSN") - 100000) % 97 == 5))


def segments_as_text(spark: SparkSession) -> DataFrame:
    """The layer from polygon text."""
    rings: dict[int, list[str]] = {}
    for code, _, x, y in VERTICES:
        rings.setdefault(code, []).append(f"{x} {y}")
    layer = [(code, f"POLYGON (({', '.join(points)}))") for code, points in rings.items()]
    return segments_from_wkt(spark.createDataFrame(layer, "segment_code int, wkt string"))


def damaged_segments(spark: SparkSession) -> DataFrame:
    """The layer as it may come: rings from another corner on, every second one backwards, some open, some with a corner twice."""
    rings: dict[int, list[tuple[float, float]]] = {}
    for code, _, x, y in VERTICES:
        rings.setdefault(code, []).append((x, y))
    vertices = []
    for code, points in rings.items():
        corners = points[:-1]
        turned = corners[code % 3 :] + corners[: code % 3]
        turned = turned[::-1] if code % 2 else turned
        turned += turned[:1] * (code % 4 // 2) + turned[-1:] * (code % 3 == 0)
        vertices += [(code, 1, i, x, y) for i, (x, y) in enumerate(turned)]
    return segments_from_vertices(spark.createDataFrame(vertices, "segment_code int, ring_no int, vertex_no int, x double, y double"))


def field_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field dictionary from the part table: brands are fields; several parts repeat a description."""
    blank = F.lit(None).cast("string")
    return read_table(spark, f"{sf_dir}/part.parquet").select(
        F.col("p_brand").alias("Data.Field_name"),
        F.col("p_type").alias("Data_type"),
        F.col("p_size").cast("string").alias("Field_length"),
        blank.alias("Units.of.Measure"),
        F.lit("0").alias("Precision"),
        F.concat(F.lit("Field "), F.col("p_brand")).alias("Description"),
        blank.alias("Date_added"),
        blank.alias("Date_discontinued"),
    )


def hostile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given documents, whose texts hold quotes, commas and line breaks, with more rows of texts that a CSV reader may take for missing ones."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    key = F.col("doc_id")
    odd = F.when(key % 8 == 0, "NA").when(key % 8 == 1, "").when(key % 8 == 2, " ").when(key % 8 == 3, '"').when(key % 8 == 4, 'a,"b",\r\n,"').when(key % 8 == 5, "\\").when(key % 8 == 6, "\n")
    return docs.unionByName(docs.select((-key - 1).alias("doc_id"), odd.alias("text"), "lang", F.when(key % 3 == 0, F.lit(None)).otherwise(F.col("source")).alias("source")))


def spelled_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hauls with their dates as text, spelled in six ways, and some that are no date."""
    date, key = F.col("Sampling_Date"), F.substring("Reference", 4, 10).cast("long")
    ways = ["yyyy-MM-dd", "yyyyMMdd", "yyyy/M/d", "yy.MM.dd", "yyyy MMM dd", "yyyy-MMMM-d"]
    text = F.when(key % 29 == 0, F.lit("2001-02-30")).when(key % 31 == 0, F.lit("unknown"))
    for i, way in enumerate(ways):
        text = text.when(key % 6 == i, F.date_format(date, way))
    return physical(spark, sf_dir).select("Reference", text.alias("Sampling_Date"))


def replace_numbers(tables: SurveyTables, records: DataFrame) -> SurveyTables:
    return dataclasses.replace(tables, numbers=records)
