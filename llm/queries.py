"""The registered queries of this package: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulscore.runtime import lookup_join
from llm import contamination, divergence, fingerprints, language_id, licences, mixing, packing, quality_model, quality_rules, repeats, simhash, variants, warc
from llm.common import crc32_of_id, table


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paired = fingerprints.with_next(
        docs, "doc_id", "text", "next_text", prepare=lambda d: fingerprints.with_sketch(d, "text", "sketch"), also={"next_sketch": "sketch"}
    )
    paired = paired.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text"))).drop("next_text")
    paired = fingerprints.with_sketch(paired, "edited", "edited_sketch")
    sketch, other, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.to_text(sketch).alias("fingerprint"),
        fingerprints.to_text(other).alias("edited_fingerprint"),
        fingerprints.likeness(sketch, other).alias("near_edited"),
        fingerprints.likeness(sketch, following).alias("near_next"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc32_of_id(F.col("doc_id")) % 3 == 1
    model = language_id.fit(language_id.training_sample(docs.where(~held_out)))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    planned = mixing.plan(docs, mixing.Target(entropy=0.95, closer=0.5, most_repeats=4.0, budget=1.0))
    drawn = mixing.mix(docs, planned).drop("text")
    weights = planned.select("source", "weight", F.col("budget").alias("budget_tokens"), F.col("tokens").alias("source_tokens"))
    return lookup_join(drawn, weights, ["source"], "left", null_safe=True)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_of_id(F.col("doc_id")) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    texts, known, share = quality_model.training_sample(docs, labels)
    scored = quality_model.score_texts(docs, quality_model.fit(texts, known, share))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(warc.decide(table(spark, sf_dir, "pages")))
    return warc.resolved(warc.read(archives)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"), change=variants.without_a_letter)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


QUERIES = {
    "op6_source_mixing": op6_source_mixing,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op1_simhash": op1_simhash,
    "op2_quality_classifier": op2_quality_classifier,
    "op4_warc": op4_warc,
    "op3_language_id": op3_language_id,
    "op9_licence_scan": op9_licence_scan,
    "op5_quality_rules": op5_quality_rules,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_decontamination": op13_decontamination,
}
