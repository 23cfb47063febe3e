"""Rendezvous sharding: the law, the numbering, and what moves."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm.sharding import shard_of, shard_rows, with_shard, write_shards

SCHEMA = "doc_id bigint, text string, shard string, _row int"


def test_law_sizes_and_slots(spark):
    rows = [(i // 3, ["é" * i, None, ""][i % 3], "x", 1) for i in range(2000)]
    rows += [(7, "same", None, None)] * 500 + [(None, "no key", "x", 1)] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = shard_rows(docs, [1.0] * 40).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    texts = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == texts
    slots, home = defaultdict(list), defaultdict(set)
    for r in found:
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
        home[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in home.values())


def test_weights_and_removal(spark):
    weights = [1.0, 2.0, 3.0, 2.0]
    keys = spark.range(40_000)
    rows = keys.select(
        "id", shard_of(F.col("id"), weights).alias("s"), shard_of(F.col("id"), weights[:3]).alias("t")
    ).collect()
    counts = Counter(r.s for r in rows)
    for shard, weight in enumerate(weights):
        assert counts[shard] == pytest.approx(40_000 * weight / sum(weights), rel=0.05)
    assert all(r.s == r.t for r in rows if r.s != 3)
    with pytest.raises(ValueError):
        shard_of(F.col("id"), [1.0, 0.0])


def test_no_rows_and_long_text(spark):
    assert shard_rows(spark.createDataFrame([], SCHEMA), [1.0] * 40).collect() == []
    row = shard_rows(spark.createDataFrame([(1, "x" * 3_000_000, "", 0)], SCHEMA), [1.0]).first()
    assert (row["size"], row.shard, row.slot) == (3_000_016, 0, 0)


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    write_shards(docs, "doc_id", [1.0] * 4, f"file://{tmp_path}/out")
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert back.exceptAll(with_shard(docs, "doc_id", [1.0] * 4)).count() == 0 and back.count() == 500
