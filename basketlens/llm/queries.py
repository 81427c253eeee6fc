"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import basketlens.llm.pipeline as corpus
from basketlens.llm.chat import rotate_perspectives
from basketlens.llm.common import table
from basketlens.llm.decontaminate import find_contamination
from basketlens.llm.exact_dedup import exact_duplicates
from basketlens.llm.fim import fim_digests
from basketlens.llm.licenses import scan_licenses
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.lm import score_documents
from basketlens.llm.manifest import dataset_manifest, proof_digest
from basketlens.llm.mixing import mix_sources
from basketlens.llm.near_dedup import near_duplicates
from basketlens.llm.quality import classify_quality
from basketlens.llm.substring_dedup import repeated_passages
from basketlens.llm.suffix_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("loss_spans", lambda s: F.concat_ws(":", s["start"], s["stop"]))
    return rotate_perspectives(table(spark, sf_dir, "conversations")).withColumn("loss_spans", F.array_join(spans, " "))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "license", "containment")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of this query asks for two words; the pipeline's stage takes five."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return kept.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = dataset_manifest(table(spark, sf_dir, "documents"))
    return manifest.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.run(spark, sf_dir)


def llm_queries() -> dict[str, Query]:
    operators = {
        name: function
        for name, function in globals().items()
        if name.startswith("op") and name[2:].split("_")[0].isdigit()
    }
    return operators | {"pipeline": pipeline}
