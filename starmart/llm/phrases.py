"""Repeated-phrase removal with sharded Aho-Corasick automata.

1. One scan marks every text: word count, a hash of its word sequence, and its anchors. A run
   of `window` words holds window - phrase + 1 phrases; its anchor is the phrase with the
   smallest hash. Equal runs have equal anchors, and neighbouring runs mostly share one, so a
   fourteenth of the phrases stands for all. Where an anchor lies is not kept.
2. Texts with the same word sequence are settled by that alone; the one with the smallest
   doc_id goes on. An anchor found in two of those is a recurring phrase. This is a grouping by
   hash, with partial sums before the shuffle. Its words are read off one text that holds it.
3. Texts with a recurring phrase (no other can hold a repeated run) are dealt to shards, by the
   smallest of their phrases, so that texts that share passages mostly meet. A shard holds a
   bounded number of words: one with more is cut, and a text with more phrases than an automaton
   takes is sent once for each share of them. The phrases of a shard's texts come first in it and
   are compiled into one automaton over words, each word being one character; then its texts
   stream through to locate every occurrence.
4. Every run around an occurrence is hashed to 128 bits and its smallest doc_id found; runs that
   start in a smaller doc_id cover the words to be removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import BROADCAST_IDS, by_value, having, scratch, written
from starmart.llm.tokens import (
    WINDOW_BASES,
    Words,
    lists,
    signed,
    slices,
    text_hashes,
    window_hashes,
    words,
)

by_value(__name__)

MARKS = (
    "doc_id bigint, text_key bigint, n_words bigint, whole bigint, whole2 bigint, "
    "kept_sha256 string, anchors array<bigint>"
)
PHRASES = "anchor bigint, phrase binary"
RUNS = "doc_id bigint, text_key bigint, run bigint, run2 bigint, place int, more array<int>"
CLEANED = "doc_id bigint, whole bigint, whole2 bigint, n_removed bigint, cut_sha256 string"
# Words of the texts of a shard, and phrases of an automaton, at most (one text may have more words).
SHARD_WORDS, AUTOMATON_PHRASES = 400_000, 30_000
# One character per word: hash modulo PLANE, past the surrogates.
PLANE, SURROGATES = 0x100000, 0xD800
EMPTY = hashlib.sha256(b"").hexdigest()


def kept_text(words_kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words_kept)).hexdigest()


def _run_anchors(found: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place: the smallest phrase hash in the run that starts there, and if there is one."""
    low = window_hashes(found.hashes, phrase)
    width, need = 1, window - phrase + 1
    while 2 * width <= need:
        low[: len(low) - width] = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    rest = need - width
    if rest:
        low[: len(low) - rest] = np.minimum(low[: len(low) - rest], low[rest:])
    _, left = found.places()
    return low, left >= window


def mark(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, text = batch.column("doc_id"), batch.column("text")
        for a, b in slices(text):
            part = text.slice(a, b - a)
            found = words(part)
            anchor, valid = _run_anchors(found, window, phrase)
            place, _ = found.places()
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1])
            new &= valid
            counts = np.bincount(place[new], minlength=b - a)
            whole = [
                kept_text((t or "").encode().split()) for t in part.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), batch.column("text_key").slice(a, b - a),
                 pa.array(found.counts.astype(np.int64)),
                 *[signed(text_hashes(found, base)) for base in WINDOW_BASES], pa.array(whole),
                 lists(anchor[new], counts)],
                ["doc_id", "text_key", "n_words", "whole", "whole2", "kept_sha256", "anchors"],
            )


def as_characters(hashes: np.ndarray) -> str:
    codes = (hashes % np.uint64(PLANE)).astype(np.uint32)
    codes[codes >= SURROGATES] += 0x800
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def spell(batches: Iterator[pa.RecordBatch], phrase: int) -> Iterator[pa.RecordBatch]:
    """The words, as hashes, of the phrases that each text is to tell."""
    for batch in batches:
        text, wanted = batch.column("text"), batch.column("own")
        for a, b in slices(text):
            found = words(text.slice(a, b - a))
            grams = window_hashes(found.hashes, phrase)
            asked = wanted.slice(a, b - a)
            asked = np.unique(np.asarray(asked.flatten()).astype(np.int64).view(np.uint64))
            _, left = found.places()
            at = np.flatnonzero((left >= phrase) & np.isin(grams, asked))
            told, one = np.unique(grams[at], return_index=True)
            spelt = [found.hashes[place : place + phrase].tobytes() for place in at[one]]
            yield pa.RecordBatch.from_arrays(
                [signed(told), pa.array(spelt, pa.binary())], ["anchor", "phrase"]
            )


class Shard:
    """The automaton of one shard, compiled when its first text comes."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.ready = False

    def add(self, phrases: pa.Array) -> None:
        for phrase in phrases:
            self.automaton.add_word(as_characters(np.frombuffer(phrase.as_buffer(), np.uint64)))

    def places(self, text: np.ndarray) -> list[int]:
        """Where the last word of each occurrence lies."""
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        return [end for end, _ in self.automaton.iter(as_characters(text))] if len(self.automaton) else []


def locate(
    batches: Iterator[pa.RecordBatch], window: int, phrase: int
) -> Iterator[pa.RecordBatch]:
    """Every text's runs around occurrences of its shard's phrases; rows come shard by shard,
    phrases first.

    A run that a text repeats is one row, with its first place and the further ones.
    """
    own, shard = None, Shard()
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "share", "kind"))))
        starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
        for low, high in zip(starts, [*starts[1:], len(keys)]):
            if keys[low][:3] != own:
                own, shard = keys[low][:3], Shard()
            rows = batch.slice(low, high - low)
            if keys[low][3] == 0:
                shard.add(rows.column("phrase"))
            else:
                for a, b in slices(rows.column("text")):
                    yield _runs(rows.slice(a, b - a), shard, window, phrase)


def _runs(rows: pa.RecordBatch, shard: Shard, window: int, phrase: int) -> pa.RecordBatch:
    found = words(rows.column("text"))
    covered = np.zeros(len(found.hashes) + 1, np.int64)
    for row in np.flatnonzero(found.counts >= window):
        low, high = found.first[row], found.first[row + 1]
        begin = low + np.array(shard.places(found.hashes[low:high]), np.int64) - phrase + 1
        np.add.at(covered, np.maximum(low, begin - (window - phrase)), 1)
        np.add.at(covered, np.minimum(begin, high - window) + 1, -1)
    at = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
    row = np.searchsorted(found.first, at, side="right") - 1
    one, two = (window_hashes(found.hashes, window, base)[at] for base in WINDOW_BASES)
    order = np.lexsort((at, two, one, row))
    at, row, one, two = at[order], row[order], one[order], two[order]
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    places = (at - found.first[row]).astype(np.int32)
    counts = np.diff(np.flatnonzero(np.concatenate((new, [True]))))
    ends = np.concatenate(([0], np.cumsum(counts - 1))).astype(np.int32)
    more = pa.ListArray.from_arrays(pa.array(ends), pa.array(places[~new]))
    more = pa.compute.if_else(pa.array(counts > 1), more, pa.scalar(None, more.type))
    take = pa.array(row[new])
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id").take(take), rows.column("text_key").take(take),
         signed(one[new]), signed(two[new]), pa.array(places[new]), more],
        ["doc_id", "text_key", "run", "run2", "place", "more"],
    )


def cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Remove the runs that start at the given places."""
    for batch in batches:
        removed, sums = [], []
        for text, places in zip(
            batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True
        ):
            every = text.encode().split()
            steps = np.zeros(len(every) + 1, np.int64)
            np.add.at(steps, places, 1)
            np.add.at(steps, np.array(places) + window, -1)
            gone = np.cumsum(steps)[:-1] > 0
            removed.append(int(gone.sum()))
            sums.append(kept_text([every[i] for i in np.flatnonzero(~gone)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("whole"), batch.column("whole2"),
             pa.array(removed, pa.int64()), pa.array(sums, pa.string())],
            ["doc_id", "whole", "whole2", "n_removed", "cut_sha256"],
        )


def remove_repeats(docs: DataFrame, window: int = 50, phrase: int = 25) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of docs (doc_id, text).

    Removed is each word inside a run of `window` words whose sequence also starts in a text
    with a smaller doc_id, judged on the input. kept_sha256 is of the other words joined by one
    space.

    Defined cases: NULL, empty and shorter texts lose nothing; repeats within one text stay. A
    row whose doc_id is NULL neither removes nor loses words. Rows with the same doc_id do not
    remove each other; equal ones come out as often as they come in. No rows give no rows. Other
    columns are not read.
    """
    folder = scratch(docs.sparkSession, "phrases")
    # Rows that share a doc_id are told apart by their texts.
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    marks = written(texts.mapInArrow(lambda it: mark(it, window, phrase), MARKS), f"{folder}/marks")

    known = marks.where(f"doc_id is not null and n_words >= {window}")
    one = F.struct("doc_id", "text_key")
    first = known.groupBy("whole", "whole2").agg(
        F.min(one).alias("one"), F.first("anchors").alias("anchors"), F.max("n_words").alias("n_words")
    )
    placed = first.select("one.*", "whole", "whole2", "n_words", F.explode("anchors").alias("anchor"))
    recurring = placed.groupBy("anchor").agg(F.min(one).alias("low"), F.max("doc_id").alias("high"))
    # Few rows are left of many: a file for every few megabytes, not for every task.
    recurring = recurring.where("low.doc_id < high").select("anchor", "low")
    recurring = written(recurring.hint("rebalance"), f"{folder}/recurring")
    carriers = placed.join(recurring, "anchor").groupBy("doc_id", "text_key", "whole", "whole2").agg(
        F.collect_set("anchor").alias("anchors"), F.max("n_words").alias("n_words")
    )
    carriers = _dealt(written(carriers, f"{folder}/carriers"), folder)
    ids = ["doc_id", "text_key"]
    chosen = having(texts.where("doc_id is not null"), carriers.select("text_key").distinct(), "text_key")
    routes = carriers.select(*ids, "whole", "whole2", "shard", "part", "shares")
    if routes.count() <= BROADCAST_IDS:
        routes = F.broadcast(routes)
    held = written(chosen.join(routes, ids), f"{folder}/held")

    tellers = recurring.groupBy("low").agg(F.collect_list("anchor").alias("own")).select("low.*", "own")
    told = held.select(*ids, "text").join(tellers, ids)
    phrases = told.mapInArrow(lambda it: spell(it, phrase), PHRASES)
    runs = written(
        _streams(held, carriers, phrases).mapInArrow(lambda it: locate(it, window, phrase), RUNS),
        f"{folder}/runs",
    )
    owners = runs.groupBy("run", "run2").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    # Written, so that both sides of the join are plain shuffles, whose hot runs can be split.
    owners = owners.where("low < high").select("run", "run2", "low")
    owners = written(owners.hint("rebalance"), f"{folder}/owners")
    repeats = runs.join(owners, ["run", "run2"]).where("doc_id > low")
    every = F.concat(F.array("place"), F.coalesce("more", F.array().cast("array<int>")))
    places = repeats.groupBy(*ids).agg(
        F.array_distinct(F.flatten(F.collect_set(every))).alias("places")
    )
    cleaned = held.join(places, ids)
    cleaned = cleaned.mapInArrow(lambda it: cut(it, window), CLEANED)
    cleaned = cleaned.dropDuplicates(["doc_id", "whole", "whole2"])
    copied = written(
        known.groupBy("whole", "whole2")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id < last_id")
        .drop("last_id"),
        f"{folder}/copied",
    )
    return _assembled(marks, copied, cleaned)


def _dealt(carriers: DataFrame, folder: str) -> DataFrame:
    """carriers with their shard, its part and the number of shares their phrases are cut into.

    Texts go by the smallest of their phrases. A shard with more than SHARD_WORDS is cut into parts.
    """
    total = carriers.agg(F.sum("n_words")).first()[0] or 0
    number = max(1, -(-total // SHARD_WORDS))
    own = carriers.withColumns({
        "shard": F.pmod(F.xxhash64(F.array_min("anchors")), F.lit(number)).cast("long"),
        "shares": F.ceil(F.size("anchors") / F.lit(AUTOMATON_PHRASES)).cast("int"),
    })
    parts = own.groupBy("shard").agg(
        F.ceil(F.sum("n_words") / F.lit(SHARD_WORDS)).cast("long").alias("parts")
    )
    parts = written(parts.where("parts > 1"), f"{folder}/parts")
    number = F.coalesce("parts", F.lit(1).cast("long"))
    cut = own.join(parts, "shard", "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_key"), number)
    )
    return written(cut.drop("parts"), f"{folder}/dealt")


def _streams(held: DataFrame, carriers: DataFrame, phrases: DataFrame) -> DataFrame:
    """For each shard, part and share its phrases (kind 0) and then its texts (kind 1)."""
    place = ["shard", "part", "share"]
    share = F.pmod(F.xxhash64("anchor"), F.col("shares")).cast("int").alias("share")
    wanted = carriers.select("shard", "part", "shares", F.explode("anchors").alias("anchor"))
    wanted = wanted.select("shard", "part", share, "anchor").distinct()
    none = {c: F.lit(None).cast(t) for c, t in (("doc_id", "long"), ("text_key", "long"), ("text", "string"))}
    first = wanted.join(phrases, "anchor").select(*place, F.lit(0).alias("kind"), "phrase")
    first = first.withColumns(none)
    then = held.select(
        "shard", "part", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("phrase"), "doc_id", "text_key", "text",
    )
    return first.unionByName(then).repartition(*place).sortWithinPartitions(*place, "kind")


def _assembled(marks: DataFrame, copied: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Copies lose all, texts with repeats some, the others nothing.

    copied is a written table, so that a large group of copies can be split in the join.
    """
    rows = marks.drop("anchors", "text_key").join(copied, ["whole", "whole2"], "left")
    rows = rows.join(cleaned, ["doc_id", "whole", "whole2"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(EMPTY))
        .otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
    )
