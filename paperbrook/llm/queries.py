"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperbrook.llm import (
    chaining, context_tree, decontaminate, mixing, packing, periodic, permutation, prefix_trie, quality, secret_scan, simhash,
    toxicity, warc,
)
from paperbrook.llm.common import table
from paperbrook.llm.training import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    word = F.lpad(F.lower(F.hex("f0")), 16, "0")
    return found.select("doc_id", word.alias("fingerprint"), "component_id")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken)


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin(*secret_scan.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s.kind)
    of_kind = [F.size(kinds) - F.size(F.array_remove(kinds, kind)) for kind in secret_scan.BASE_KINDS]
    counts = [n.cast("bigint").alias(f"n_{kind}") for n, kind in zip(of_kind, secret_scan.BASE_KINDS, strict=True)]
    digest = F.sha2(secret_scan.span_list(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.span_list(F.col("spans")).alias("spans"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.token_output(table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), heads)


@query
def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = context_tree.scores(table(spark, sf_dir, "documents"), id_remainder(7) != 2)
    held_out = F.coalesce(id_remainder(7) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.periodic_runs(docs, F.crc32(docs["doc_id"].cast("string").cast("binary")))
