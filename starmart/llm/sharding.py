"""Weighted rendezvous sharding.

Every shard draws a score for a record's key, -weight / ln(u) with u a hash of (key, shard), and
the highest score has the record. A shard is chosen with a probability in proportion to its
weight. Scores do not depend on the other shards: a shard that is added takes only records whose
best score it beats, one that is removed gives up only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import content_sums, numbered, scratch

RECORD_OVERHEAD = 16


def score(key: Column, shard: Column, weight: Column) -> Column:
    """The shard's score for the key; 53 bits of a 64-bit hash make u, never 0 or 1."""
    draw = F.shiftrightunsigned(F.xxhash64(key, shard), 11)
    return -weight / F.ln((draw + 0.5) / F.lit(2.0**53))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score; of equal scores the lowest number."""
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    known = F.array(*[F.lit(float(w)) for w in weights])
    scores = F.transform(
        known, lambda w, i: F.struct(score(key, i, w).alias("score"), (-i).alias("shard"))
    )
    return -F.array_max(scores)["shard"]


def with_shard(docs: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """docs with the shard of each record's key. No shuffle. Records with a NULL key share one shard."""
    return docs.withColumn(out, shard_of(F.col(key), weights))


def shard_rows(docs: DataFrame, weights: Sequence[float], added: float = 1.0) -> DataFrame:
    """Per row of docs (doc_id, text): its size, its shard, its place there, and where it goes next.

    size: UTF-8 bytes of the text plus 16. slot: the row's place in its shard, gapless from 0, by
    a hash of (doc_id, text_crc32, size). grown_shard: the shard when one of weight `added` joins.

    Defined cases: a NULL text has size 16 and checksum 0, as an empty one. Equal keys share a
    shard, whatever their texts; rows with a NULL key do too. Equal rows have slots of their own.
    No rows give no rows. Other columns are not read.
    """
    text, key = F.coalesce("text", F.lit("")), F.col("doc_id")
    rows = docs.select(
        key,
        (F.octet_length(text) + RECORD_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, added]).alias("grown_shard"),
    )
    rows = numbered(rows, scratch(docs.sparkSession, "sharding"))
    placed = content_sums(rows, "shard", ["doc_id", "text_crc32", "size"], F.lit(1), "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, key: str, weights: Sequence[float], path: str) -> None:
    """One folder per shard; a shard's records may fill several files, each written by one task."""
    with_shard(docs, key, weights).write.partitionBy("shard").parquet(path)
