"""From raw documents to training shards, five stages one after the other.

Every stage gets what its predecessor kept, as a written table, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import cotraining
from starmart.llm.common import scratch, written
from starmart.llm.decontaminate import clean
from starmart.llm.jaccard import drop_near_copies
from starmart.llm.mixing import mix_documents
from starmart.llm.sharding import with_shard

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier, fitted on the given labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.keep_good(docs, cotraining.train(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their five-word shingles."""
    return drop_near_copies(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return clean(docs, benchmark, least=13, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each source: a row per document and pass, cut where the mix is."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with their shard, by rendezvous hashing of doc_id."""
    return with_shard(docs, "doc_id", [1.0] * SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

# The classifier is fitted iteratively and the mix drawn at random: SQL cannot say it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents after all stages, each but the last written and read again."""
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
