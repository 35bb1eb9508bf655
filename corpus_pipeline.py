"""A corpus pipeline: each stage calls one operator of ``rareclass.llm`` on what the stage before it kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.  Null and empty texts pass the filters
(``drop_near_copies`` keeps one of them, as they share a fingerprint); an empty table passes through empty; extra columns
are carried along.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareclass.llm import decontam, mixing, sharding, simhash, toxicity
from rareclass.llm.catalog import MIX, SHARDS
from rareclass.llm.common import checkpoint_dir, ship_package, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go.  The grammar is fitted on the labelled documents of the table itself."""
    ship_package(spark)
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    ship_package(spark)
    return simhash.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it."""
    ship_package(spark)
    return mixing.mix(docs, **MIX)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    ship_package(spark)
    sized = docs.withColumn("shard_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8)
    return sharding.shuffle_into_shards(sized, SHARDS, "shard_bytes")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_duplicates", near_duplicates_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Models, fingerprints and seeded permutations are not SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results in between are written to the shared checkpoint folder."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    folder = os.path.join(checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    *early, (_, last) = STAGES
    for n, (name, stage) in enumerate(early):
        path = os.path.join(folder, f"{n}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return last(spark, docs, sf_dir)
