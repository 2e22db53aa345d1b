"""A corpus pipeline of five stages, each of which calls one operator of millrace.llm.

Every stage takes all rows that its predecessor kept, and what it decides takes
effect: quality rules and decontamination drop documents, near-dedup keeps one of
each group, mixing samples, sharding places what is left.

Defined results, for every stage: all columns of documents stay, whatever their
names, and the last stage adds those of sharding; null text has no words, so quality
rules drop it; rows without doc_id are rows like others; of rows that are equal in
doc_id and text near-dedup keeps one; rows with one doc_id and different texts are
different documents; an empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decision_list, mixing, near_dups, sharding, winnowing
from millrace.llm.store import delete, folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near-duplicates in the pipeline: shingles of five words, similarity 0.8.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rule or the learned decision list rejects."""
    return decision_list.passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return near_dups.keep_one(docs, PERCENT, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return winnowing.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents to the target marginals of source, language and topic."""
    return mixing.sampled(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place what is left in shards 0 to 7: documents with all their columns, size, text_crc32, law, shard, slot and grown_shard. Documents that share lines are neighbours: of equal texts near-dedup has left one."""
    return sharding.with_shards(docs, 8, sharding.shared_lines(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_weights),
    ("sharding", shards),
]

#: Learned rules, signatures, raking and propagation have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents. Each result is written to the shared folder and read again; once the next one is written, it is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{base}/{i}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                delete(spark, before)
            before = path
    return docs
