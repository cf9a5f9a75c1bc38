"""From raw documents to shards: the stages of a training corpus, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationcast.llm import decontamination, minhash, mixing, quality, sharding
from stationcast.llm.store import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field, fitted on the labelled ones, does not reject. Null, empty and wordless
    texts take the sample's share of good documents; repeated rows share their fate; null ids have no
    label; an empty table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-equal texts, the one with the smallest id; a null id only where a
    class has no other. Null and empty texts are one class; of repeated rows one stays."""
    return minhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. Null and empty texts stay; repeated rows share their
    fate; without items all stay."""
    return decontamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target word count asks for, 0 to 3 times. Null sources are one
    source, the last; texts without words count nothing; an empty table stays empty."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard (0 to 39) as a column. Null texts weigh their overhead, rows equal in id and
    text share a shard; an empty table stays empty."""
    return sharding.shard_rows(docs)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Fitted models and checksums cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
