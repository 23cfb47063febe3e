"""Mixing sources to target weights with block-shuffled, exactly repeatable draws.

The words of a source, text after text, are packed into blocks of a fixed length. A target says
how many words the mix takes: whole passes over the source, then some of its blocks, the last one
cut to the word. How many slots of an output shard each source fills is drawn down a tree over the
shards: the slots of a node are split between its halves by a multinomial over what the sources
have in it, so that shards are mixed at random and the totals come out exact. Every draw is seeded
by its node, so a task works out the shards it is given from the root, and none is made on the
driver. The slots of a source run through a pseudorandom permutation of its block numbers, another one for
each pass, and are joined with the blocks' contents by (source, block).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starmart.llm.common import (
    WORD,
    by_value,
    content_sums,
    numbered,
    scratch,
    word_count,
    written,
)
from starmart.llm.tokens import mix

by_value(__name__)

BLOCK_WORDS = 1024
SHARD_SLOTS = 8192
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
ROUNDS = 6
# Numbers of slots a task keeps of the splits it has drawn; others are drawn again.
KEPT_COUNTS = 1 << 20


class Source(NamedTuple):
    number: int
    name: str | None
    size: int
    target: Fraction


class Mix(NamedTuple):
    """sources: the plan. rows: the input with _row, _source and size. picks: what the mix takes."""

    sources: DataFrame
    rows: DataFrame
    picks: DataFrame


def targets(
    sizes: list[int], weights: list[int], total: int, most: int = MOST_PASSES
) -> list[Fraction]:
    """Shares of total by weight; none above most times its size, the excess shared on."""
    found = [Fraction(0)] * len(sizes)
    free, left = set(range(len(sizes))), Fraction(total)
    while free:
        every = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / every > most * sizes[i]}
        for i in over or free:
            found[i] = Fraction(most * sizes[i]) if over else left * weights[i] / every
        if not over:
            break
        free -= over
        left -= sum(found[i] for i in over)
    return found


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """index mapped by the key's permutation of 0 to size - 1: a Feistel network, walked back in."""
    out = index.astype(np.uint64)
    known, which = np.unique(size, return_inverse=True)
    half = np.array([max(1, (int(n - 1).bit_length() + 1) // 2) for n in known], np.uint64)[which]
    mask = (np.uint64(1) << half) - np.uint64(1)
    size, key = size.astype(np.uint64), key.astype(np.int64).view(np.uint64)
    open_ = np.ones(len(out), bool)
    while open_.any():
        left, right = out[open_] >> half[open_], out[open_] & mask[open_]
        for turn in range(ROUNDS):
            drawn = mix(right + mix(key[open_] + np.uint64(turn)))
            left, right = right, (left ^ drawn) & mask[open_]
        out[open_] = (left << half[open_]) | right
        open_ = out >= size
    return out.astype(np.int64)


@F.arrow_udf(LongType())
def _permuted(index: pa.Array, size: pa.Array, key: pa.Array) -> pa.Array:
    return pa.array(permuted(*[np.asarray(x).astype(np.int64) for x in (index, size, key)]))


class SlotTree:
    """Which slots of each source the output shards get, however many shards there are.

    A node is a range of shards; a leaf's slots follow from the splits on its way from the root.
    """

    def __init__(self, slots: list[int], shard_slots: int, seed: int):
        self.slots, self.shard_slots, self.seed = np.array(slots, np.int64), shard_slots, seed
        self.total = int(self.slots.sum())
        self.shards = -(-self.total // shard_slots)
        self.known: dict[tuple[int, int], np.ndarray] = {}

    def room(self, low: int, high: int) -> int:
        return min(high * self.shard_slots, self.total) - low * self.shard_slots

    def left(self, low: int, high: int, counts: np.ndarray) -> np.ndarray:
        """Slots of the first half of a node's shards, by source."""
        if (low, high) not in self.known:
            if len(self.known) * len(counts) >= KEPT_COUNTS:
                self.known.clear()
            random = np.random.default_rng([self.seed, low, high])
            found, room = np.zeros(len(counts), np.int64), self.room(low, (low + high) // 2)
            while room:
                free = counts - found
                drawn = np.minimum(random.multinomial(room, free / free.sum()), free)
                found, room = found + drawn, room - int(drawn.sum())
            self.known[low, high] = found
        return self.known[low, high]

    def shard(self, number: int) -> list[tuple[int, int, int, int]]:
        """(shard, source, first slot, slots) of the sources that a shard has slots of."""
        low, high, counts, first = 0, self.shards, self.slots, np.zeros(len(self.slots), np.int64)
        while high - low > 1:
            left, middle = self.left(low, high, counts), (low + high) // 2
            if number < middle:
                counts, high = left, middle
            else:
                first, counts, low = first + left, counts - left, middle
        return [(number, int(s), int(first[s]), int(counts[s])) for s in np.flatnonzero(counts)]


def shard_batches(batches: Iterator[pa.RecordBatch], tree: SlotTree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [run for number in batch.column("id").to_pylist() for run in tree.shard(number)]
        columns = list(zip(*runs)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "_source", "first", "n"]
        )


def mix_sources(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    seed: int = 1,
) -> Mix:
    """Plan the mix of docs (doc_id, source, _size in words): what it takes, piece by piece.

    The names of the sources and their sizes pass through the driver and are broadcast; texts,
    blocks, slots and output shards do not. Further columns of docs come back in rows, so they must
    not have the names used here: callers put them into one struct. picks: (shard, slot, turn, _source,
    block, _row, start, words): in its slot, the mix takes `words` words of row _row from word
    `start`; turn numbers the pass over the source.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "mixing")
    rows = numbered(docs, f"{folder}/rows")
    totals = rows.groupBy("source").agg(F.sum("_size").alias("size")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"]))
    sizes = [r["size"] for r in totals]
    wanted = targets(
        sizes, [weights[i % len(weights)] for i in range(len(totals))],
        round(sum(sizes) * Fraction(str(share))),
    )
    sources = [Source(i, r["source"], r["size"], t)
               for i, (r, t) in enumerate(zip(totals, wanted, strict=True))]
    plan = [_quota(s, block_words) for s in sources]
    named = spark.createDataFrame(
        [(s.number, s.name, s.size, float(s.target), *p) for s, p in zip(sources, plan, strict=True)],
        "_source int, _name string, source_size bigint, target double, blocks bigint, "
        "full bigint, passes bigint, extra bigint, cut bigint",
    )
    tagged = rows.join(
        F.broadcast(named.select("_source", "_name")), F.col("source").eqNullSafe(F.col("_name"))
    ).drop("_name")

    narrow = tagged.where("_size > 0").select("_source", "doc_id", "_part", "_row", "_size")
    placed = content_sums(narrow, "_source", ["doc_id", "_size"], F.col("_size"), "at")
    block = F.explode(F.sequence(
        F.expr(f"at div {block_words}"), F.expr(f"(at + _size - 1) div {block_words}")
    )).alias("block")
    pieces = placed.select("_source", "_row", "at", "_size", block).select(
        "_source", "block", "_row",
        F.greatest(F.col("block") * block_words - F.col("at"), F.lit(0)).alias("start"),
        F.greatest(F.col("at") - F.col("block") * block_words, F.lit(0)).alias("inside"),
        (F.least(F.col("at") + F.col("_size"), (F.col("block") + 1) * block_words)
         - F.greatest("at", F.col("block") * block_words)).alias("held"),
    )
    tree = SlotTree([_slot_count(p) for p in plan], shard_slots, seed)
    slots = _slots(spark, named, tree, block_words)
    picks = slots.join(pieces, ["_source", "block"])
    words = F.least("held", F.col("take") - F.col("inside"))
    picks = picks.withColumn("words", words).where("words > 0").select(
        "shard", "slot", "turn", "_source", "block", "_row", "start", "words"
    )
    return Mix(named, tagged, picks)


def _quota(source: Source, block_words: int) -> tuple[int, int, int, int, int]:
    """(blocks, full blocks, whole passes, further full blocks, words of the last, cut block)."""
    full, tail = divmod(source.size, block_words)
    wanted = int(source.target + Fraction(1, 2))
    passes, left = divmod(wanted, source.size) if source.size else (0, 0)
    return full + (tail > 0), full, passes, left // block_words, left % block_words


def _slot_count(quota: tuple[int, int, int, int, int]) -> int:
    blocks, _, passes, extra, cut = quota
    return passes * blocks + extra + (cut > 0)


def _slots(spark, sources: DataFrame, tree: SlotTree, block_words: int) -> DataFrame:
    """A row per slot: its block, the pass it belongs to, and the words it takes from the block."""
    runs = spark.range(tree.shards).mapInArrow(
        lambda it: shard_batches(it, tree), "shard bigint, _source int, first bigint, n bigint"
    )
    slots = runs.join(F.broadcast(sources), "_source").select(
        "*", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("k")
    )
    whole = F.col("k") < F.col("passes") * F.col("blocks")
    turn = F.when(whole, F.expr("k div blocks")).otherwise(F.col("passes"))
    rest = F.col("k") - F.col("passes") * F.col("blocks")
    # A part pass takes full blocks only; the cut words come from the next one, or the short tail.
    tail = ~whole & (rest >= F.col("full"))
    index = F.when(whole, F.expr("k % blocks")).otherwise(F.when(tail, F.lit(0)).otherwise(rest))
    size = F.when(whole, F.col("blocks")).otherwise(F.greatest("full", F.lit(1)))
    key = F.xxhash64(F.lit(tree.seed), F.coalesce("_name", F.lit("")), F.isnull("_name"), turn)
    block = F.when(tail, F.col("full")).otherwise(_permuted(index, size, key))
    take = F.when(whole | (rest < F.col("extra")), F.lit(block_words)).otherwise(F.col("cut"))
    return slots.select(
        "shard", F.col("k").alias("slot"), turn.alias("turn"), "_source", block.alias("block"),
        take.cast("bigint").alias("take"),
    )


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """Per row of docs (doc_id, text, source): how many of its words the mix takes.

    (doc_id, size, source_size, target, taken). size counts the words; sources in the order of
    their code points, NULL last, weigh 5, 2, 1, 5, ... and share all words; no target exceeds
    three times its source, what is over goes to the others by weight.

    Defined cases: NULL and blank texts have size 0 and are not taken. A source without words has
    target 0. NULL is a source like others. Equal rows are separate texts. No rows give no rows.
    Other columns are not read. The same rows give the same mix,
    however the input is split (of equal doc_id and size, any).
    """
    mixed = mix_sources(docs.select("doc_id", "source", word_count("text").alias("_size")),
                        **options)
    taken = mixed.picks.groupBy("_row").agg(F.sum("words").alias("taken"))
    plan = F.broadcast(mixed.sources.select("_source", "source_size", "target"))
    return (
        mixed.rows.select("_row", "doc_id", "_size", "_source")
        .join(plan, "_source")
        .join(taken, "_row", "left")
        .select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of docs: one row per text and pass that takes words of it.

    A text taken whole is unchanged. Of a text taken in part, the words taken are joined by one
    blank, and n_chars, where there is such a column, is counted anew. Rows keep all columns,
    whatever their names.
    """
    own = docs.select(
        "doc_id", "source", word_count("text").alias("_size"), F.struct(*docs.columns).alias("_own")
    )
    mixed = mix_sources(own, **options)
    parts = mixed.picks.groupBy("_row", "turn").agg(
        F.sum("words").alias("_words"),
        F.sort_array(F.collect_list(F.struct("start", "words"))).alias("_pieces"),
    ).drop("turn")
    text = F.col("_own")["text"]
    every = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    cut = F.concat_ws(" ", F.flatten(F.transform(
        "_pieces", lambda p: F.slice(F.col("_all"), p["start"].cast("int") + 1, p["words"].cast("int"))
    )))
    whole = F.col("_words") == F.col("_size")
    rows = mixed.rows.join(parts, "_row")
    rows = rows.withColumn("_all", F.when(~whole, every))
    rows = rows.withColumn("_text", F.when(whole, text).otherwise(cut))
    columns = {c: F.col("_own")[c] for c in docs.columns} | {"text": F.col("_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(whole, columns["n_chars"]).otherwise(F.length("_text"))
    return rows.select(*[value.alias(name) for name, value in columns.items()])
