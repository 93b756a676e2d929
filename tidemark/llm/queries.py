"""Registered queries of this subpackage; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, licenses, minhash, mixing, packing, pii, prefix_trie, quality, sharding, spelling, token_files, toxicity, warc
from tidemark.llm.shared import cut, table


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.assess(docs).drop("text", "source")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), token_files.new_folder(spark)))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents")).drop("source")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def revisit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.records_of_pages(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda x: F.concat(x["key"], F.lit(": "), x["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = cut(licenses.windows(docs))
    return licenses.scan(docs, licenses.train(docs, found=found), found=found)


def histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_frequency": quality_rules,
    "op2_setsketch_dedup": near_duplicates,
    "op3_best_two_fit": best_fit_packing,
    "op4_seekable_tokens": token_id_files,
    "op5_cube_mix": source_mix,
    "op6_compression_toxicity": toxicity_scores,
    "op7_projection_forest": nearest_vectors,
    "op8_revisit_resolution": revisit_records,
    "op9_license_scan": license_scan,
    "op10_histogram_shards": histogram_shards,
    "op11_hash_trie": conversation_trie,
    "op12_weak_pii": personal_data,
    "op13_gram_spelling": spelling_variants,
}
