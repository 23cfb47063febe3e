"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Texts are compared by their sets of distinct word n-grams, held as 64-bit hashes. Texts with
the same set are one class; only classes are compared.

1. One scan writes (doc_id, set size, class) and the n-grams that are common already within
   one batch of some thousand texts. Summed, they give the hot n-grams: those in at least one of HOT_SHARE
   classes, at most HOT_SHARE times the mean set size, whatever the corpus. They rank last in
   the rare-first order and never travel.
2. A second scan sends every other n-gram of a class to the range it falls into, packed to
   about six bytes. A range counts documents per n-gram, and returns the n-grams seen in two
   classes or more to their class. N-grams of a single class come first in the order but can
   join nothing; a class with too few shared n-grams is out.
3. What is left is joined on its prefix n-grams. Within an n-gram's group, classes meet one
   hub first; pairs inside what has become one component are never formed, so a large group of
   near copies costs a few joins of its size. A last join takes all pairs that are still in
   different components, so no link between different texts is lost.
4. Each pair is verified once, first by how a pivot splits both sets (the suffix filter), then
   by the exact overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import by_value, having, scratch, spare, written
from starmart.llm.components import components
from starmart.llm.tokens import mix, signed, slices, window_hashes, words

by_value(__name__)

HOT_SHARE = 2_000
TOKEN_BITS = 48
PART_TOKENS = 1_000_000
BATCH_ROWS = 1 << 16
BATCH_TOKENS = 1_500_000
HUB_ROUNDS = 1
HOT_RANK = np.uint32(2**32 - 1)

SETS = "doc_id bigint, n_shingles bigint, class bigint, token bigint, seen bigint"
PACKED = "part bigint, kind int, a binary, b binary, c binary, d binary"
CANDIDATES = (
    "class bigint, n bigint, single bigint, typical bigint, tokens binary, prefix array<bigint>"
)


# ---- sets ---------------------------------------------------------------------


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a shorter text is one n-gram, if any."""
    found = words(column, lower=True)
    counts = found.counts
    _, left = found.places()
    grams = window_hashes(found.hashes, n)
    for text in np.flatnonzero((counts > 0) & (counts < n)):
        at, size = found.first[text], counts[text]
        run = window_hashes(found.hashes[at : at + size], int(size))
        grams[at] = mix(run[:1] + mix(np.array([size], np.uint64)))[0]
        left[at] = n
    kept = left >= n
    ends = np.concatenate(([0], np.cumsum(kept)))[found.first]
    grams = grams[kept]
    return [np.unique(grams[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def class_id(tokens: np.ndarray) -> np.uint64:
    """A hash of the set itself, whatever the order."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return mix(np.array([total + np.uint64(len(tokens))], np.uint64))[0]


def _common(classes: dict[int, np.ndarray], share: int) -> pa.RecordBatch:
    """N-grams that a tell-tale part of the batch's classes hold."""
    least = max(2, len(classes) // share)
    every = np.sort(np.concatenate([*classes.values(), np.zeros(0, np.uint64)]))
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else []
    seen = np.diff(np.concatenate((starts, [len(every)]))).astype(np.int64)
    token, seen = every[starts][seen >= least], seen[seen >= least]
    none = pa.nulls(len(token), pa.int64())
    return pa.RecordBatch.from_arrays(
        [none, none, none, signed(token), pa.array(seen)],
        ["doc_id", "n_shingles", "class", "token", "seen"],
    )


def describe(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    classes, held = {}, 0
    for batch in batches:
        ids, text = batch.column("doc_id"), batch.column("text")
        for a, b in slices(text):
            sets = shingle_sets(text.slice(a, b - a), n)
            keys = np.array([class_id(s) if len(s) else 0 for s in sets], np.uint64)
            sizes = np.array([len(s) for s in sets], np.int64)
            classes |= {int(k): s for k, s in zip(keys, sets, strict=True) if len(s)}
            held += int(sizes.sum())
            if held > BATCH_TOKENS:
                yield _common(classes, HOT_SHARE)
                classes, held = {}, 0
            none = pa.nulls(b - a, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(sizes), signed(keys), none, none],
                ["doc_id", "n_shingles", "class", "token", "seen"],
            )
    yield _common(classes, HOT_SHARE)


# ---- packing ------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as the first one and fixed-width differences."""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = gaps.view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + values[:1].tobytes() + body.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    width, body = blob[0], np.frombuffer(blob, np.uint8, offset=9)
    gaps = np.zeros((len(body) // width, 8), np.uint8)
    gaps[:, :width] = body.reshape(-1, width)
    return np.cumsum(
        np.concatenate((np.frombuffer(blob, np.uint64, 1, 1), gaps.view(np.uint64).ravel())),
        dtype=np.uint64,
    )


def numbers(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip("part kind a b c d".split(), row, strict=True)) for row in rows],
        schema=pa.schema(
            [("part", pa.int64()), ("kind", pa.int32()), *[(c, pa.binary()) for c in "abcd"]]
        ),
    )


def _send(classes: dict[int, np.ndarray], hot: np.ndarray, parts: int) -> pa.RecordBatch:
    """kind 0: n-grams for a range. kind 1: each class's size and hot n-grams, for its bucket."""
    keys = np.fromiter(classes, np.uint64, len(classes))
    sizes = np.array([len(s) for s in classes.values()], np.uint32)
    every = np.concatenate(list(classes.values()))
    every >>= np.uint64(64 - TOKEN_BITS)
    place = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    warm = _in(hot, every)
    cold = every[~warm] << np.uint64(16)
    cold |= place[~warm]
    cold.sort()
    width = -(-(1 << TOKEN_BITS) // parts)
    part = (cold >> np.uint64(16)) // np.uint64(width)
    rows = []
    # Ranges without n-grams of this batch cost nothing, however many there are.
    for run in np.split(cold, np.flatnonzero(np.diff(part)) + 1):
        if len(run):
            number = int(run[0] >> np.uint64(16)) // width
            held, local = np.unique(run & np.uint64(0xFFFF), return_inverse=True)
            run = (run & ~np.uint64(0xFFFF)) | local.astype(np.uint64)
            rows.append((number, 0, pack(run), keys[held].tobytes(), None, None))
    bucket = keys % np.uint64(parts)
    warm_by_class = np.split(every[warm], np.cumsum(np.bincount(place[warm].astype(np.int64),
                                                                minlength=len(sizes)))[:-1])
    order = np.argsort(bucket, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        lists = [warm_by_class[i] for i in own]
        rows.append((int(bucket[own[0]]), 1, keys[own].tobytes(), sizes[own].tobytes(),
                     np.array([len(x) for x in lists], np.uint32).tobytes(),
                     np.concatenate(lists).tobytes()))
    return _packed(rows)


def send(
    batches: Iterator[pa.RecordBatch], n: int, hot: np.ndarray, parts: int
) -> Iterator[pa.RecordBatch]:
    classes, size = {}, 0
    for batch in batches:
        text = batch.column("text")
        for a, b in slices(text):
            for tokens in shingle_sets(text.slice(a, b - a), n):
                if not len(tokens) or (key := int(class_id(tokens))) in classes:
                    continue
                classes[key] = tokens
                size += len(tokens)
                if len(classes) == BATCH_ROWS or size > BATCH_TOKENS:
                    yield _send(classes, hot, parts)
                    classes, size = {}, 0
    if classes:
        yield _send(classes, hot, parts)


def count_range(table: pa.Table, parts: int) -> pa.Table:
    """Document frequencies of a range's n-grams; those of two classes or more go back."""
    rows = table.to_pylist()
    out = [tuple(r.values()) for r in rows if r["kind"] == 1]
    tokens, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for row in rows:
        if row["kind"] == 0:
            run = unpack(row["a"])
            tokens.append(run >> np.uint64(16))
            keys.append(numbers(row["b"], np.uint64)[(run & np.uint64(0xFFFF)).astype(np.int64)])
    token, key = np.concatenate(tokens), np.concatenate(keys)
    order = np.lexsort((key, token))
    token, key = token[order], key[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
    token, key = token[new], key[new]
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else []
    times = np.diff(np.concatenate((starts, [len(token)]))).astype(np.int64)
    often = np.repeat(times, times)
    token, key, often = (x[often > 1] for x in (token, key, often))
    bucket = key % np.uint64(parts)
    order = np.lexsort((token, key, bucket))
    token, key, often, bucket = (x[order] for x in (token, key, often, bucket))
    for run in np.split(np.arange(len(token)), np.flatnonzero(np.diff(bucket)) + 1):
        if len(run):
            held, counts = np.unique(key[run], return_counts=True)
            out.append((int(bucket[run[0]]), 0, held.tobytes(),
                        counts.astype(np.uint32).tobytes(),
                        token[run].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                        often[run].astype(np.uint32).tobytes()))
    return pa.Table.from_batches([_packed(out)])


# ---- candidates -----------------------------------------------------------------


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """With so many n-grams in both sets together: the smallest overlap that links them."""
    return -(-percent * sizes // (100 + percent))


def assemble(table: pa.Table, percent: int) -> pa.Table:
    """Each class's shared n-grams; kept are the classes with enough of them for any partner."""
    sizes: dict[int, int] = {}
    tokens, keys, ranks = ([np.zeros(0, t)] for t in (np.uint64, np.uint64, np.uint32))
    for row in table.to_pylist():
        held = numbers(row["a"], np.uint64)
        if row["kind"] == 1:
            own = np.array([int(k) not in sizes for k in held])
            sizes |= dict(zip(held.tolist(), numbers(row["b"], np.uint32).tolist(), strict=True))
            counts = numbers(row["c"], np.uint32)
            own = np.repeat(own, counts)
            tokens.append(numbers(row["d"], np.uint64)[own])
            keys.append(np.repeat(held, counts)[own])
            ranks.append(np.full(len(tokens[-1]), HOT_RANK))
        else:
            wide = np.zeros((len(row["c"]) // 6, 8), np.uint8)
            wide[:, :6] = numbers(row["c"], np.uint8).reshape(-1, 6)
            tokens.append(wide.view(np.uint64).ravel())
            keys.append(np.repeat(held, numbers(row["b"], np.uint32)))
            ranks.append(numbers(row["d"], np.uint32))
    token, key, rank = (np.concatenate(x) for x in (tokens, keys, ranks))
    order = np.lexsort((token, rank, key))
    token, key, rank = token[order], key[order], rank[order]
    out = []
    for run in np.split(np.arange(len(token)), np.flatnonzero(np.diff(key)) + 1):
        if not len(run):
            continue
        size = sizes[int(key[run[0]])]
        if 100 * len(run) < percent * size:
            continue
        single = size - len(run)
        prefix = size - -(-percent * size // 100) + 1 - single
        own = token[run]
        out.append({
            "class": int(key[run[0]].view(np.int64)), "n": size, "single": single,
            "typical": int(rank[run].sum(dtype=np.int64)) // size, "tokens": np.sort(own).tobytes(),
            "prefix": own[: max(0, prefix)].view(np.int64).tolist(),
        })
    kinds = [("class", pa.int64()), ("n", pa.int64()), ("single", pa.int64()),
             ("typical", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64()))]
    return pa.Table.from_pylist(out, schema=pa.schema(kinds))


# ---- pairs ----------------------------------------------------------------------


def may_link(percent: int, left: str, right: str) -> Column:
    """Length filter, and positional filter: were this the first common n-gram of two linked
    sets, which one is, enough n-grams must be left from here on in both."""
    small, large = F.least(f"{left}.n", f"{right}.n"), F.greatest(f"{left}.n", f"{right}.n")
    after = F.least(
        F.col(f"{left}.n") - F.col(f"{left}.pos"), F.col(f"{right}.n") - F.col(f"{right}.pos")
    )
    both = F.col(f"{left}.n") + F.col(f"{right}.n")
    return (100 * small >= percent * large) & ((100 + percent) * after >= percent * both)


def _pairs(joined: DataFrame, left: str, right: str) -> DataFrame:
    a, b = F.col(f"{left}.class"), F.col(f"{right}.class")
    return joined.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def hub_pairs(postings: DataFrame, percent: int, turn: int) -> DataFrame:
    """In each n-gram's group: every class with the group's hub, unless connected already.

    The first hub is the class whose n-grams are the most frequent ones, as those of the text
    are that the others were copied from; later hubs are drawn.
    """
    draw = F.col("typical") if turn == 0 else F.xxhash64("class", F.lit(turn))
    hub = F.max(F.struct(draw.alias("draw"), "class", "n", "pos", "label"))
    hubs = postings.groupBy("token").agg(
        hub.alias("h"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    hubs = hubs.where("low < high").select(F.col("token").alias("hub_token"), "h")
    joined = postings.select("token", F.struct("class", "n", "pos", "label").alias("p")).join(
        hubs, F.col("token") == F.col("hub_token")
    )
    return _pairs(joined.where((F.col("p.label") != F.col("h.label"))
                               & may_link(percent, "p", "h")), "p", "h")


def cross_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """In each n-gram's group: all pairs of classes that are not connected yet."""
    mixed = postings.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.where("low < high").select("token")
    some = postings.join(mixed, "token")
    # What the filters can say of whole components: some member is long enough, with room left.
    groups = some.groupBy("token", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"),
        F.max(F.col("n") - F.col("pos")).alias("room"),
    )
    sides = [
        groups.select("token", *[F.col(c).alias(f"{x}_{c}") for c in groups.columns[1:]])
        for x in ("left", "right")
    ]
    met = sides[0].join(sides[1], "token").where(
        f"left_label < right_label "
        f"and 100 * left_most >= {percent} * right_least "
        f"and 100 * right_most >= {percent} * left_least "
        f"and {100 + percent} * least(left_room, right_room) "
        f"  >= {percent} * (left_least + right_least)"
    )
    met = met.select("token", F.col("left_label").alias("left"), F.col("right_label").alias("right"))
    side = [F.struct("class", "n", "pos").alias(x) for x in "pq"]
    joined = met.join(
        some.select("token", F.col("label").alias("left"), side[0]), ["token", "left"]
    ).join(some.select("token", F.col("label").alias("right"), side[1]), ["token", "right"])
    return _pairs(joined.where(may_link(percent, "p", "q")), "p", "q")


def may_overlap(a: np.ndarray, b: np.ndarray, differ: int, depth: int = 3) -> bool:
    """Suffix filter: a pivot splits both sets; what sizes alone must differ, adds up."""

    def least(x: np.ndarray, y: np.ndarray, level: int) -> int:
        if not level or not len(x) or not len(y):
            return abs(len(x) - len(y))
        at = len(y) // 2
        cut = int(np.searchsorted(x, y[at]))
        return least(x[:cut], y[:at], level - 1) + least(x[cut:], y[at:], level - 1)

    return least(a, b, depth) <= differ


def verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for row in batch.select(["na", "nb", "ta", "tb"]).to_pylist():
            a, b = numbers(row["ta"], np.uint64), numbers(row["tb"], np.uint64)
            both = row["na"] + row["nb"]
            need = -(-percent * both // (100 + percent))
            alone = both - len(a) - len(b)
            linked.append(
                may_overlap(a, b, both - 2 * need - alone)
                and len(np.intersect1d(a, b, assume_unique=True)) >= need
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
            ["a", "b", "linked"],
        )


def verified(pairs: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    sides = {
        x: candidates.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"),
                             F.col("tokens").alias(f"t{x}"))
        for x in "ab"
    }
    return pairs.join(sides["a"], "a").join(sides["b"], "b").mapInArrow(
        lambda it: verify(it, percent), "a bigint, b bigint, linked boolean"
    )


# ---- the operator -----------------------------------------------------------------


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    A-Z are lower-cased, words are runs of non-blanks, the set holds the distinct n-grams of
    words; a text with 1 to n - 1 words has its whole sequence as its one n-gram. Two texts
    link when 100 * overlap >= percent * union. component_id is the smallest doc_id that
    links lead to.

    Defined cases: NULL, empty and blank texts have no n-grams and link with nothing; their
    component_id is their own doc_id. Repeated rows come out as often as they come in. A row
    whose doc_id is NULL takes part as a text, and gets the smallest known doc_id of its
    component, or NULL. No rows give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "jaccard")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    facts = written(texts.mapInArrow(lambda it: describe(it, n), SETS), f"{folder}/sets")
    sets = facts.where("token is null").select("doc_id", "n_shingles", "class")
    filled = sets.where("n_shingles > 0")
    total = filled.agg(F.sum("n_shingles"), F.count(F.lit(1))).first()
    parts = max(1, -(-(total[0] or 0) // PART_TOKENS))
    hot = facts.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
    hot = hot.where(F.col("seen") >= max(20, (total[1] or 0) // HOT_SHARE))
    hot = hot.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64)
    hot = np.unique(hot >> np.uint64(64 - TOKEN_BITS))

    packed = texts.mapInArrow(lambda it: send(it, n, hot, parts), PACKED)
    shared = packed.groupBy("part").applyInArrow(lambda t: count_range(t, parts), PACKED)
    candidates = written(
        shared.groupBy("part").applyInArrow(lambda t: assemble(t, percent), CANDIDATES),
        f"{folder}/candidates",
    )
    postings = candidates.select(
        "class", "n", "single", "typical", F.posexplode("prefix").alias("at", "token")
    ).select("token", "class", "n", "typical", (F.col("single") + F.col("at")).alias("pos"))

    labels, links, done = None, None, None
    for turn in range(HUB_ROUNDS + 1):
        label = F.col("class") if labels is None else F.coalesce("label", "class")
        named = postings if labels is None else postings.join(
            labels.withColumnRenamed("node", "class"), "class", "left"
        )
        named = named.withColumn("label", label)
        pairs = (
            hub_pairs(named, percent, turn) if turn < HUB_ROUNDS else cross_pairs(named, percent)
        )
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        checked = written(verified(pairs, candidates, percent), f"{folder}/checked-{turn}")
        done = checked if done is None else done.unionAll(checked)
        links = done.where("linked")
        labels = written(components(links, f"{folder}/stars-{turn}"), f"{folder}/labels-{turn}")

    grouped = filled.join(labels.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "class"))
    lowest = grouped.groupBy("label").agg(
        F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("rows")
    )
    # Written, so that both sides of the join are plain shuffles, whose hot groups can be split.
    lowest = written(lowest.where("rows > 1").select("label", "lowest"), f"{folder}/lowest")
    several = F.col("lowest").isNotNull()
    component = F.when(several, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id")
    columns = ["doc_id", "n_shingles", "component_id"]
    return grouped.join(lowest, "label", "left").select(*columns[:2], component).unionAll(
        sets.where("n_shingles = 0").select(*columns[:2], F.col("doc_id").alias("component_id"))
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: one with the smallest doc_id, NULL last.

    Each row is judged by its own text, whatever its id: rows that share an id but no text both
    stay, and rows without an id are found like others. Of rows with the same id and text one
    stays, and all of those without words. Rows are told apart by 64-bit hashes. Columns are kept.
    """
    folder = scratch(docs.sparkSession, "near-copies")
    name = spare(docs, "_row")
    rows = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    judged = rows.select(F.col(name).alias("doc_id"), "text")
    found = jaccard_components(judged, n, percent).where("n_shingles > 0")
    found = written(found.groupBy(F.col("doc_id").alias(name), F.col("component_id").alias("component")).agg(
        F.count(F.lit(1)).alias("copies")), f"{folder}/components")
    several = written(
        found.groupBy("component").agg(F.sum("copies").alias("rows")).where("rows > 1").select("component"),
        f"{folder}/several",
    )
    members = written(found.join(several, "component"), f"{folder}/members")
    ids = having(rows.select(name, F.col("doc_id").alias("own")), members.select(name), name).distinct()
    first = F.min(F.struct(F.col("own").isNull(), "own", name)).alias("first")
    kept = members.join(ids, name).groupBy("component").agg(first).select(F.col("first")[name].alias(name))
    kept = written(kept, f"{folder}/kept")
    gone = written(members.select(name).join(kept, name, "left_anti"), f"{folder}/gone")
    left = having(rows, gone, name, "left_anti")
    again = written(members.where("copies > 1").select(name).join(kept, name, "left_semi"), f"{folder}/again")
    if again.isEmpty():
        return left.drop(name)
    once = having(left, again, name).dropDuplicates([name])
    return having(left, again, name, "left_anti").unionByName(once).drop(name)
