"""From raw documents to a mixed, sharded training corpus.

Each stage calls one operator of ``accrualkit.llm`` on all rows that the stage
before has kept, and returns the columns of documents; the last one adds where
each row goes.  ``run`` writes every stage's rows to the shared folder and
reads them back, so a lost executor never repeats more than one stage.

Defined cases: null ids and texts are ordinary values of documents; empty
texts are kept (as one group of near duplicates); very long texts are read
whole; repeated rows are near duplicates of each other; an empty table passes
as an empty one; columns beyond those of documents are kept, whatever their
names are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.llm import decontaminate, mixing, sharding, simhash, toxicity
from accrualkit.llm.common import documents, set_apart, stored, table

SHARDS = 8


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    net = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", 5, 0)
    return toxicity.without_toxic(docs, net)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it; columns called like a new one become ``input_<name>``."""
    own = set_apart(docs, "size", "text_crc32", "law", "shard", "slot")
    sized = own.select("*", *sharding.shard_sizes(F.col("text")))
    placed = sharding.shard(sized, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], SHARDS)
    return placed.withColumn("law", F.lit("rows"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Trained scores and random draws have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
