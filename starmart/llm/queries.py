"""Registered queries: each applies one operator with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import cotraining
from starmart.llm.decontaminate import overlaps
from starmart.llm.jaccard import jaccard_components
from starmart.llm.mixing import mix_counts
from starmart.llm.oracles import oracle_sql  # noqa: F401
from starmart.llm.phrases import remove_repeats
from starmart.llm.pieces import encoding_digests
from starmart.llm.pii import find_personal_data
from starmart.llm.prefix_trie import trie_nodes
from starmart.llm.rules import judge, labelled_statistics, learn
from starmart.llm.secrets import find_secrets, samples, train
from starmart.llm.sharding import shard_rows
from starmart.llm.warc import archived_pages
from starmart.llm.whitening import whitened_components

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return cotraining.train_and_score(documents, labels)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return find_secrets(documents, train(samples(documents, labels)))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return overlaps(documents, benchmark, least=13, percent=80)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return judge(documents, learn(labelled_statistics(documents, labels)))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"), least=0)


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), [1.0] * 40)


def op8_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), window=50, phrase=25)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=5, percent=80)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(table(spark, sf_dir, "conversations"))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return encoding_digests(table(spark, sf_dir, "documents"), model)


def queries() -> dict[str, Query]:
    found = [
        op1_quality_classifier,
        op2_secrets,
        op3_decontaminate,
        op4_mix_sources,
        op5_quality_rules,
        op6_warc_revisits,
        op7_shards,
        op8_repeated_phrases,
        op9_ngram_jaccard,
        op10_personal_data,
        op11_whitening,
        op12_prefix_trie,
        op13_sentence_pieces,
    ]
    return {query.__name__: query for query in found}
