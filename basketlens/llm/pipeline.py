"""The stages of the corpus pipeline and their composition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, ship_package, table
from basketlens.llm.decontaminate import drop_contaminated
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.mixing import mix_sources
from basketlens.llm.near_dedup import keep_one_of_each
from basketlens.llm.quality import quality_score, train_quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts."""
    forest = train_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(forest) >= 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove boilerplate lines; a document of which no words are left goes.

    What such a document held stands at the first occurrence of its lines.
    """
    cleaned = dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    text = F.col("text")
    out = cleaned.where(~emptied).drop("n_lines", "n_removed")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five words, 0.8)."""
    return keep_one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark items."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix that draws every document at least once and none more than four times."""
    return mix_sources(docs, budget_tokens=None)


def _shipped(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _shipped(keep_quality)),
    ("lines", _shipped(drop_repeated_lines)),
    ("near_copies", _shipped(keep_one_of_near_copies)),
    ("benchmark", _shipped(drop_benchmark_passages)),
    ("mix", _shipped(mix)),
]

#: The classifier and the tiling have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
