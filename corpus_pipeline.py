"""A training corpus from raw documents: quality, near duplicates, repeated passages, benchmark passages, mixture.

Each stage gets all rows its predecessor kept, written as Parquet and read again. All stages but the last return the
columns of ``documents``; the last adds ``copy``, the number of a document's copy in the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatproof.llm.common import table
from flatproof.llm.decontamination import decontaminate
from flatproof.llm.mixing import emit_copies, mix_sources
from flatproof.llm.quality import fit_quality, score_quality
from flatproof.llm.simhash import keep_first_of_groups
from flatproof.llm.substring_dedup import remove_repeated_words
from flatproof.session import remove, scratch_path, scratch_scope

QUALITY_THRESHOLD = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; learnt from the labelled ones among the given documents."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where(F.col("score") >= QUALITY_THRESHOLD).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, null last, then by its text."""
    return keep_first_of_groups(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand elsewhere too."""
    return remove_repeated_words(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of benchmark items."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture, one row per copy."""
    return emit_copies(mix_sources(docs)).select(*docs.columns, "copy")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]

#: The fitted classifier can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has staged goes once its rows are written, and these once the next
    stage has read them."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-").lower())
        with scratch_scope(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        if held:
            remove(spark, held)
        docs, held = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
