"""Index metrics the plain way, one aggregate and one join each: a check on the fused plan, and its yardstick."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulscore.functions import ratio, zero_if
from haulscore.operators import assemble

NAMES = ("NumTaxa", "NumIndiv", "Shannon", "TaxaSelect", "NumGuilds", "BenthicTaxa", "BenthicAbund", "PelagicTaxa", "PelagicAbund")


def literal_metrics(counts: DataFrame) -> DataFrame:
    def per_haul(name, aggregate, of=counts):
        return of.groupBy("Reference").agg(aggregate.alias(name))

    indiv = per_haul("NumIndiv", F.sum("Total_N"))
    shares = counts.join(indiv, "Reference").withColumn("p", ratio(F.col("Total_N"), F.col("NumIndiv")))
    parts = [
        per_haul("NumTaxa", F.count_distinct(F.when(F.col("NODCCODE") != "9998000000", F.col("NODCCODE"))).cast("double")),
        indiv,
        per_haul("Shannon", F.lit(0.0) - F.sum(F.col("p") * F.ln("p")), shares),
        per_haul("TaxaSelect", F.count_if(F.col("Selected_Taxa") == "Y").cast("double")),
        per_haul("NumGuilds", F.count_distinct(F.coalesce("Feeding_Guild", F.lit(""))).cast("double")),
    ]
    for name, code in (("Benthic", "B"), ("Pelagic", "P")):
        own = F.col("Hab_Cat") == code
        parts.append(per_haul(f"{name}Taxa", F.count_if(own).cast("double")))
        parts.append(per_haul(f"{name}Abund", F.sum(F.when(own, F.col("Total_N")).otherwise(0.0))))
    empty = F.col("NumIndiv") == 0
    return assemble(*parts).select("Reference", *[zero_if(empty, F.col(n)).alias(n) for n in NAMES])
