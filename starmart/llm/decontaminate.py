"""Benchmark decontamination by spaced seeds.

A mask looks at some of the words of a span and ignores the others, so a passage keeps most of
its seeds when words are substituted. All masks are laid at every place of the benchmark texts
and of the training texts. An item shorter than the masks has one seed, of all its words; the
training texts are looked through for seeds of the lengths that occur.

1. Benchmark seeds are a table. Two bits of each seed are set in a bitmap of fixed size (8 MB),
   the only thing that is broadcast.
2. One scan of the training texts lays the masks and keeps the seeds whose bits are set; a text
   without any is done. This scan shuffles nothing.
3. Kept seeds are joined with the benchmark's by hash. A hit fixes how the two texts are aligned;
   equal alignments are verified once, by the best-scoring stretch of enough aligned words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import by_value, having, scratch, spare, written
from starmart.llm.tokens import WINDOW_BASES, Words, mix, signed, slices, text_hashes, words

by_value(__name__)

# 1: the word counts, 0: it is ignored. Any two substitutions in 13 words leave a seed.
MASKS = ("1101011", "1110101", "1011011", "1111110", "1001111")
BITMAP_BITS = 26
# Words here are runs of letters and digits (any byte over 127 is taken for one), in lower case.
SHORT = 1 << 32
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True

SEEDS = "text_id bigint, place bigint, seed bigint"
HELD = "doc_id bigint, whole bigint, words binary, places array<bigint>, seeds array<bigint>"
ITEMS = "item_id bigint, words binary, places array<bigint>, seeds array<bigint>"
OVERLAPS = (
    "doc_id bigint, whole bigint, item_id bigint, doc_start bigint, item_start bigint, "
    "n_words bigint, n_equal bigint, covers_item boolean"
)


def seeds(hashes: np.ndarray, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(place, seed) of every mask at every place where it fits."""
    places, found = [], []
    for number, mask in enumerate(masks):
        fit = len(hashes) - len(mask) + 1
        if fit <= 0:
            continue
        value = np.full(fit, number + 1, np.uint64)
        for at, kept in enumerate(mask):
            if kept == "1":
                value = mix(value ^ hashes[at : at + fit])
        places.append(np.arange(fit))
        found.append(value)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(found)


def short_seeds(hashes: np.ndarray, length: int) -> np.ndarray:
    """The seed of every run of length words, all of which count."""
    value = np.full(max(0, len(hashes) - length + 1), SHORT + length, np.uint64)
    for at in range(length):
        value = mix(value ^ hashes[at : at + len(value)])
    return value


def bits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each seed."""
    return values >> np.uint64(64 - BITMAP_BITS), values & np.uint64((1 << BITMAP_BITS) - 1)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    hit = np.ones(len(values), bool)
    for bit in bits(values):
        hit &= (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def item_seeds(
    batches: Iterator[pa.RecordBatch], masks: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        text = batch.column("text")
        for a, b in slices(text):
            found = words(text.slice(a, b - a), INSIDE, lower=True)
            for row in range(b - a):
                own = found.hashes[found.first[row] : found.first[row + 1]]
                places, values = seeds(own, masks)
                if 0 < len(own) < min(map(len, masks)):
                    places, values = np.zeros(1, np.int64), short_seeds(own, len(own))
                rows.append({
                    "item_id": batch.column("item_id")[a + row].as_py(), "words": own.tobytes(),
                    "places": places.tolist(), "seeds": values.view(np.int64).tolist(),
                })
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("item_id", pa.int64()), ("words", pa.binary()),
            ("places", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64())),
        ]))


def scan(
    batches: Iterator[pa.RecordBatch], masks: tuple[str, ...], bitmap: np.ndarray, shorts: list[int]
) -> Iterator[pa.RecordBatch]:
    """Texts with seeds whose bits are set; of a short item's seed the first place in each text."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("whole", pa.int64()), ("words", pa.binary()),
        ("places", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64())),
    ])
    for batch in batches:
        text, rows = batch.column("text"), []
        for a, b in slices(text):
            found = words(text.slice(a, b - a), INSIDE, lower=True)
            places, values = seeds(found.hashes, masks)
            hit = np.flatnonzero(in_bitmap(bitmap, values))
            places, values = places[hit], values[hit]
            for length in shorts:
                first, seed = _first_places(found, short_seeds(found.hashes, length), length, bitmap)
                places, values = np.concatenate((places, first)), np.concatenate((values, seed))
            row = np.searchsorted(found.first, places, side="right") - 1
            order = np.argsort(row, kind="stable")
            whole = text_hashes(found, WINDOW_BASES[0]).view(np.int64)
            for run in np.split(order, np.flatnonzero(np.diff(row[order])) + 1):
                if len(run):
                    doc = row[run[0]]
                    low, high = found.first[doc], found.first[doc + 1]
                    rows.append({
                        "doc_id": batch.column("doc_id")[a + doc].as_py(),
                        "whole": int(whole[doc]),
                        "words": found.hashes[low:high].tobytes(),
                        "places": (places[run] - low).tolist(),
                        "seeds": values[run].view(np.int64).tolist(),
                    })
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _first_places(
    found: Words, values: np.ndarray, length: int, bitmap: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of the seeds whose bits are set and that lie in one text, the first place in each text."""
    hit = np.flatnonzero(in_bitmap(bitmap, values))
    row = np.searchsorted(found.first, hit, side="right") - 1
    inside = hit + length <= found.first[row + 1]
    hit, row = hit[inside], row[inside]
    order = np.lexsort((hit, values[hit], row))
    seed, text = values[hit][order], row[order]
    new = np.ones(len(order), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])
    return hit[order][new], seed[new]


def best_stretch(equal: np.ndarray, percent: int, least: int) -> tuple[int, int] | None:
    """The stretch of at least `least` words with the best score, None where none has one from 0.

    100 - percent for an equal word, minus percent otherwise: 0 is reached by `percent` of equal
    words. A better but shorter stretch inside, or beside, does not count.
    """
    if len(equal) < least:
        return None
    steps = np.where(equal, 100 - percent, -percent)
    sums = np.concatenate(([0], np.cumsum(steps)))
    scores = sums[least:] - np.minimum.accumulate(sums[: len(sums) - least])
    last = int(np.argmax(scores))
    return (int(np.argmin(sums[: last + 1])), last + least) if scores[last] >= 0 else None


def verify(
    batches: Iterator[pa.RecordBatch], least: int, percent: int
) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in OVERLAPS.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.bool_()]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            doc, item = (np.frombuffer(r[x], np.uint64) for x in ("part", "item_words"))
            skip = max(0, -r["shift"])
            size = min(len(doc), len(item) - skip)
            equal = doc[:size] == item[skip : skip + size]
            # An item of fewer words must be met from end to end.
            stretch = best_stretch(equal, percent, min(least, len(item)))
            if stretch:
                a, b = stretch
                rows.append((r["doc_id"], r["whole"], r["item_id"], max(0, r["shift"]) + a,
                             skip + a, b - a, int(equal[a:b].sum()), b - a == len(item)))
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    least: int = 13,
    percent: int = 80,
) -> DataFrame:
    """One row per (doc_id, item_id) that share a passage, with its best alignment.

    docs (doc_id, text) and benchmark (item_id, text). A passage is a stretch of at least
    `least` aligned words, or of a shorter item's all words, of which at least `percent` in a
    hundred are equal; its alignment holds at least one seed: the words that one of the masks
    looks at are equal, or all words of an item shorter than every mask. Texts are compared as runs of letters and digits with A-Z lower-cased.

    Columns: doc_id, item_id, doc_start, item_start (in words), n_words, n_equal, covers_item.

    Defined cases: NULL and empty texts share nothing.
    Rows with NULL ids are compared like others and carry the NULL. Equal rows give one row. No
    rows on either side give no rows. Other columns are not read.
    """
    folder = scratch(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    items = written(items.mapInArrow(lambda it: item_seeds(it, masks), ITEMS), f"{folder}/items")
    bitmap = _bitmap(items)
    size = (F.length("words") / 8).cast("int")
    short = items.where((size > 0) & (size < min(map(len, masks)))).select(size.alias("size"))
    shorts = sorted(r.size for r in short.distinct().collect())

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    held = written(
        texts.mapInArrow(lambda it: scan(it, masks, bitmap, shorts), HELD), f"{folder}/held"
    )
    spread = [F.explode(F.arrays_zip("places", "seeds")).alias("s")]
    doc_seeds = held.select("doc_id", "whole", *spread)
    known = items.select("item_id", *spread)
    hits = doc_seeds.select("doc_id", "whole", "s.*").join(
        known.select("item_id", F.col("s.places").alias("at"), "s.seeds"), "seeds"
    )
    shift = F.col("places") - F.col("at")
    aligned = hits.select("doc_id", "whole", "item_id", shift.alias("shift")).distinct()
    found = (
        aligned.join(
            items.select(F.col("item_id").alias("own"), F.col("words").alias("item_words")),
            F.col("item_id").eqNullSafe(F.col("own")),
        )
        .join(
            held.select(F.col("doc_id").alias("held_id"), F.col("whole").alias("held_whole"),
                        "words"),
            F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("whole") == F.col("held_whole")),
        )
        .select(
            "doc_id", "whole", "item_id", "shift", "item_words",
            F.expr(
                "substring(words, cast(8 * greatest(shift, 0) + 1 as int), "
                "cast(length(item_words) as int))"
            ).alias("part"),
        )
        .mapInArrow(lambda it: verify(it, least, percent), OVERLAPS)
    )
    best = F.max(F.struct("n_equal", "n_words", (-F.col("doc_start")).alias("d"),
                          (-F.col("item_start")).alias("i"), "covers_item"))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select(
        "doc_id", "item_id", (-F.col("b.d")).alias("doc_start"), (-F.col("b.i")).alias("item_start"),
        "b.n_words", "b.n_equal", "b.covers_item",
    )


def _bitmap(items: DataFrame) -> np.ndarray:
    """Set bits, gathered as 64-bit words: at most 2**(BITMAP_BITS - 6) rows reach the driver."""
    seed = items.select(F.explode("seeds").alias("seed"))
    high = F.shiftrightunsigned("seed", 64 - BITMAP_BITS)
    low = F.col("seed").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bit = seed.select(F.explode(F.array(high, low)).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")
    )
    found = rows.toPandas()
    whole = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    whole[found["at"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64)
    return whole.view(np.uint8)


def clean(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of docs that share no passage with the benchmark.

    Each row is judged by its own text, whatever its id: rows without an id and rows that share one
    too. Texts are told apart by 64-bit hashes. Columns are kept.
    """
    own, name = F.xxhash64("text"), spare(docs, "_text")
    judged = docs.where("text is not null").select(own.alias("doc_id"), "text")
    folder = scratch(docs.sparkSession, "decontaminate-texts")
    caught = overlaps(judged, benchmark, **limits).select(F.col("doc_id").alias(name)).distinct()
    caught = written(caught, folder)
    return having(docs.withColumn(name, own), caught, name, "left_anti").drop(name)
