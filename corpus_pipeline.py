"""From raw documents to a training mix: STAGES, each written as Parquet and read again for the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import decontaminate, jaccard, lines, mixing, quality, simhash
from cadastra.llm.common import discard, held_out, shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; the model learns from labelled documents only."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5, 0))
    return quality.keep_good(docs, quality.fit(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines deleted; n_chars follows the text."""
    found = lines.drop_repeats(docs)
    return found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op1 links: fingerprints at 3 or fewer differing bits."""
    return simhash.keep_one(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more (Jaccard, 5-word shingles); not in STAGES."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, taken and the shard of each copy."""
    mixed = mixing.mix(docs)
    columns = [F.col(c) for c in docs.columns]
    return mixed.where(F.size("mix.shards") > 0).select(
        *columns,
        "mix.size",
        "mix.source_size",
        "mix.target",
        (F.size("mix.shards") * F.col("mix.size")).alias("taken"),
        "mix.shards",
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

#: The classifier and the mix's draws cannot be written in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; results between stages go to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if k:
            discard(docs)
        docs = spark.read.parquet(path)
    return docs
