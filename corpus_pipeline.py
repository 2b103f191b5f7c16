"""A corpus pipeline: quality rules, near-dedup, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import decontamination, mixing, near_duplicates, quality_rules, sharding
from folioforge.llm.common import load
from folioforge.session import materialize

SHARDS = 8
#: Tokens of each domain that are kept, as a share of those the stage is given.
KEPT = {"clean": 1.0, "noisy": 0.25, "toxic": 0.0}


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality_rules.assess(docs, load(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*docs.columns)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_duplicates.keep_one(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaking(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that meet ``KEPT``; clean ones have rate 1 and all stay."""
    rates = mixing.mix(docs, load(spark, sf_dir, "labels"), shares=KEPT, most=1.0)
    return mixing.sample(docs, rates)


def to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return sharding.shard_rows(spark, docs, SHARDS)


STAGES = [
    ("quality rules", by_quality),
    ("near duplicates", one_of_near),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", to_shards),
]

#: Hashing, learned posteriors and random walks are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
