"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import clusters, decontaminate, fingerprint, html, langid, lines, mixing, packing, quality, resample, simhash, suffix, toxicity
from cadastra.llm.common import held_out, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, labels.where(~out))
    scored = quality.score(docs.select("doc_id", "text"), model)
    score = F.col("quality_score")
    return scored.select(
        "doc_id", out.alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted")
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "line_counts.*", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_and_compare(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id",
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.size("mix.shards") * F.col("mix.size")).alias("taken"),
        "mix.shards",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 3, 1)
    model = langid.fit(docs.where(~out & F.col("lang").isNotNull()))
    return langid.label(docs, model).select(
        "doc_id", out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", F.size("spans").alias("n_spans")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, labels.where(~out))
    score = F.col("toxicity.score")
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        out.alias("held_out"),
        score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"),
        F.size("toxicity.spans").alias("n_passages"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.with_inertia(*clusters.cluster(table(spark, sf_dir, "embeddings")))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    # only the digest of the ids goes through the shuffle
    return packing.place(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_line_dedup": op4_line_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_source_mixing": op7_source_mixing,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_best_fit_packing": op13_best_fit_packing,
}

#: Queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_suffix_array_dedup": suffix.ORACLE,
    "op4_line_dedup": lines.ORACLE,
    "op5_benchmark_decontamination": decontaminate.ORACLE,
    "op11_importance_resampling": resample.ORACLE,
    "op12_centroid_clustering": clusters.ORACLE,
}
