"""From raw documents to packed token rows, in five stages; each is written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paperbrook.llm import decontaminate, mixing, packing, simhash, toxicity
from paperbrook.llm.common import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon scores as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_firsts(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until their sources have their target weights."""
    return mixing.mixed(docs)


def token_output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in packed rows of binary files; one row for each piece and its place."""
    return packing.token_output(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token output", token_output_stage),
]

# SQL has no fingerprints, pivotal rounding or token ids; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
