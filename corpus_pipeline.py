"""Training-corpus pipeline over ``documents``: each stage takes what the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs.  All but the last return the columns
of documents.  A table of zero rows passes through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from railtide.llm import decontaminate, mixing, quality, shards, simhash
from railtide.session import ensure_checkpoint_dir, prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    NULL and empty texts are scored like others.  Repeated rows are scored alike and stay all.
    """
    prepare(spark)
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Near duplicates are what ``op10_simhash`` links: fingerprints of three-word shingles that differ
    in at most three bits.  Rows without a doc_id stay; see ``simhash.keep_first`` for ties.
    """
    prepare(spark)
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item.  NULL and empty texts overlap nothing."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; NULL is a source of its own."""
    prepare(spark)
    return mixing.mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard that each is written to; equal texts share one, NULL is the empty text."""
    prepare(spark)
    return shards.with_shard(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_first),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("sharding", assign_shards),
]

# training and linking go on until nothing changes, which SQL cannot say
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what stages hand on is written below the checkpoint folder."""
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
