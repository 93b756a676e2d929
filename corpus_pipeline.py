"""Cleaning, mixing and packing of the documents table, stage by stage.

Each stage takes the rows that the one before kept and returns documents; the last returns
the pieces of the packed sequences. Stages are written and read again between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, mixing, packing, quality, toxicity
from tidemark.llm.shared import shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that too many texts of a host share."""
    return quality.clean(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic; the model learns from the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id, then text key, of each group of near duplicates, once; null ids stay.

    Different texts under one id stay if they are in different groups.
    """
    heads = minhash.linked_rows(docs).where("head").select("doc_id", F.col("tkey").alias("_tkey")).distinct()
    keyed = docs.withColumn("_tkey", F.xxhash64("text"))
    kept = keyed.join(heads, ["doc_id", "_tkey"], "left_semi").dropDuplicates(["doc_id", "_tkey"]).drop("_tkey")
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document taken twice stands there twice."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place in it."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: Trained scores, sampling and tokens are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written below the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
