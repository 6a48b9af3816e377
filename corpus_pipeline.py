"""A training corpus from raw documents, by the operators of gapledger.llm:
quality filter, toxicity filter, near-duplicate removal, benchmark
decontamination, packing. Each stage is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.llm import decontam, packing, parity_join, pu_quality, toxicity
from gapledger.llm.common import crc_remainder, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels
    of the rows that op6 learns from."""
    learned = crc_remainder("doc_id", 4) != 2
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(learned)
    return pu_quality.accepted(docs, pu_quality.fit(docs.where(learned), labels))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; labels as for op4."""
    learned = crc_remainder("doc_id", 5) != 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(learned)
    return toxicity.accepted(docs, toxicity.fit(docs.where(learned), labels))


def without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``docs`` less those whose doc_id is in ``ids``. The ids are written first,
    so Spark knows their size when it picks the join."""
    return docs.join(written(ids.select("doc_id").distinct(), name), "doc_id", "left_anti").select(docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest
    doc_id; rows without an id stay, rows that repeat an id stay or go together."""
    return without(docs, parity_join.jaccard_components(docs).where("doc_id != component_id"), "pipeline-copies")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).where(F.col("doc_id").isNotNull()),
                   "pipeline-leaks")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", clean),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The classifiers cannot be expressed in SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
