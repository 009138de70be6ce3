"""The training-data pipeline: five operators in a row over ``documents``.

Each stage gets all its predecessor kept and returns a DataFrame that is written as Parquet and read again as the
next stage's input.  All but the last keep the columns of ``documents``; sharding adds ``shard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hrlens.llm import decontaminate, mixing, neardup, sharding, toxicity
from hrlens.llm.common import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity score of 0.3 or more."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group (five-word shingles, similarity 0.8)."""
    return neardup.drop_near_duplicates(docs, n_words=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item, exact or edited."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that expected domain totals match the target weights; drops none."""
    return mixing.mix(docs, _table(spark, sf_dir, "labels"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contiguous shards of about equal bytes."""
    return sharding.shard_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix), ("sharding", shard)]

#: Trained models decide the first and fourth stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(name, stage(spark, docs, sf_dir))
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
