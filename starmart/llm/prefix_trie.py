"""The trie of all beginnings of conversations, from sorted shards and a skeleton.

A conversation is a path of turns, a turn a 128-bit hash of its role and text. Paths are sorted
together with their conversation's id and cut into shards at sampled splitters. The splitters'
beginnings form the skeleton, a trie of bounded size that is broadcast: only its nodes can have
members in several shards. Every other node lies within one shard, which finishes it in one walk
over its sorted paths with a stack; of skeleton nodes a shard gives partial aggregates, which are
reduced over the shards and then summed up along the skeleton. A path or a beginning that very many
conversations share is thus spread over shards like any other.

Paths are cut into segments of SEGMENT turns, each sorted under a hash of all turns before it, so
that no row holds a conversation of any length whole. Sums over the segments below are carried up
by doubling distances, in as many steps as the number of segments has bits.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import by_value, numbered, running_sums, scratch, written

by_value(__name__)

MODULUS, SPAN = 9, 5
SEGMENT = 64
TURN_BYTES, ROOT_BYTES = 16, 24
# Blocks in which a long conversation's turns and segments meet what belongs to it as a whole.
TURN_BLOCK, SEGMENT_BLOCK = 1 << 16, 1 << 10
SHARDS_PER_PARTITION, SAMPLES_PER_SHARD = 4, 8
CHUNK_BYTES, BATCH_RECORDS = 1 << 18, 4096
NOTHING = hashlib.sha256(b"").hexdigest()
FINISHED, PARTIAL, ENDS, ROOT = range(4)

RECORDS = (
    "kind int, key binary, conv_id bigint, depth bigint, parent_conv_id bigint, parent binary, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, "
    "size bigint, shard int, at int, ids string"
)
NAMES = [part.split()[0] for part in RECORDS.split(", ")]
KINDS = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
TYPES = [KINDS[part.split()[1]] for part in RECORDS.split(", ")]


def turns(conversations: DataFrame, folder: str) -> DataFrame:
    """conv_id, pos (from 0), key and size of every turn, written.

    Sorting deals the turns of one conversation to as many tasks as they need; positions are then
    counted per task and started from the counts of the tasks before.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat_ws(" ", F.octet_length(role).cast("string"), role, text))).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = rows.orderBy("conv_id", F.asc_nulls_first("turn"), "key", "tie").select("conv_id", "key", "size")
    counted = running_sums(numbered(rows, f"{folder}/sorted"), "conv_id", F.lit(1), "pos")
    return written(counted.select("conv_id", "pos", "key", "size"), f"{folder}/turns")


def borrowed_turns() -> Column:
    """How many first turns a conversation takes over: h."""
    return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MODULUS).cast("long")


def rebuilt(found: DataFrame, folder: str) -> DataFrame:
    """Turns of the rebuilt conversations: conv_id, pos, key, size, length; written.

    A conversation without turns has one row, with a NULL key.
    """
    base = F.col("conv_id") - F.col("conv_id") % SPAN
    lengths = found.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    plan = lengths.withColumns({"h": borrowed_turns(), "base": base}).join(
        lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("first")), "base", "left"
    )
    plan = plan.withColumn("taken", F.least("h", F.coalesce("first", F.lit(0).cast("long"))))
    plan = plan.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long")))
    plan = written(plan, f"{folder}/plan")
    firsts = found.where(F.col("pos") < MODULUS).withColumnRenamed("conv_id", "base")
    taken = plan.select("conv_id", "base", "taken", "length").join(firsts, "base").where("pos < taken")
    blocks = plan.withColumn("block", F.explode(F.expr(f"sequence(0L, (own - 1) div {TURN_BLOCK})")))
    own = found.withColumn("block", F.expr(f"pos div {TURN_BLOCK}")).join(
        blocks.select("conv_id", "block", "h", "taken", "length"), ["conv_id", "block"]
    ).where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "key", "size", "length"]
    bare = plan.where("length = 0").select(
        "conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"),
        F.lit(0).cast("long").alias("size"), "length",
    )
    rows = taken.select(columns).unionByName(own.select(columns)).unionByName(bare)
    return rows


def root_key(segment: Column, one: Column, two: Column) -> Column:
    """What the rows of one segment under one beginning share: the first bytes of their keys."""
    return F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in (segment, one, two)]))


def paths(rows: DataFrame, folder: str) -> DataFrame:
    """One row for each conversation and segment, written.

    conv_id, key (root and turns), sizes, ends (whether the conversation ends with it), segment and
    next: the root of the segments that go on from a full one.
    """
    segment = F.expr(f"pos div {SEGMENT}")
    turn = F.struct("pos", "key", "size")
    cut = rows.groupBy("conv_id", segment.alias("segment")).agg(
        F.array_sort(F.collect_list(F.when(F.col("key").isNotNull(), turn))).alias("turns"),
        F.max("length").alias("length"),
    ).select(
        "conv_id", "segment", "length",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    cut = written(cut, f"{folder}/segments")
    zero = F.lit(0).cast("long")
    short = cut.where(F.col("length") < SEGMENT).select(
        "conv_id", "segment", "length", "path", "sizes", zero.alias("one"), zero.alias("two"),
        F.lit(None).cast("binary").alias("next"),
    )
    # The beginning before a segment is known by the combined hashes of the segments in it.
    hashes = {"_one": F.xxhash64("segment", "path"), "_two": F.xxhash64(F.lit(7), "path", "segment")}
    full = cut.where(F.col("length") >= SEGMENT).withColumns(hashes).withColumn(
        "block", F.expr(f"segment div {SEGMENT_BLOCK}"))
    within = Window.partitionBy("conv_id", "block").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = full.groupBy("conv_id", "block").agg(F.bit_xor("_one").alias("_b1"), F.bit_xor("_two").alias("_b2"))
    starts = starts.select("conv_id", "block", *[
        F.coalesce(F.bit_xor(c).over(before), zero).alias(to) for c, to in (("_b1", "s1"), ("_b2", "s2"))])
    full = full.withColumns({
        to: F.coalesce(F.bit_xor(c).over(within), zero) for c, to in (("_one", "w1"), ("_two", "w2"))
    }).join(starts, ["conv_id", "block"])
    full = full.withColumns({
        "one": F.col("w1").bitwiseXOR(F.col("s1")), "two": F.col("w2").bitwiseXOR(F.col("s2"))})
    onward = root_key(F.col("segment") + 1, F.col("one").bitwiseXOR(F.col("_one")),
                      F.col("two").bitwiseXOR(F.col("_two")))
    full = full.select("conv_id", "segment", "length", "path", "sizes", "one", "two",
                       F.when(F.size("sizes") == SEGMENT, onward).alias("next"))
    whole = short.unionByName(full).select(
        "conv_id", F.concat(root_key(F.col("segment"), F.col("one"), F.col("two")), F.col("path")).alias("key"),
        "sizes", (F.col("length") <= (F.col("segment") + 1) * SEGMENT).alias("ends"), "segment", "next",
    )
    return written(whole, f"{folder}/paths")


class Below(NamedTuple):
    children: int
    leaves: int
    saved: int


class Node:
    """A node while its shard walks over its members."""

    __slots__ = ("key", "size", "skeleton", "n", "low", "children", "leaves", "saved", "below", "pending", "ends",
                 "ids", "held", "flushed")

    def __init__(self, key: bytes, size: int, skeleton: bool):
        self.key, self.size, self.skeleton = key, size, skeleton
        self.n = self.children = self.leaves = self.saved = self.held = self.flushed = 0
        self.low = self.below = self.ends = None
        self.pending: list[dict] = []
        self.ids: list[str] = []


class Walk:
    """Sorted paths in, records out: finished nodes, partial ones, ids that end, roots of segments."""

    def __init__(self, skeleton: frozenset[bytes]):
        self.skeleton, self.shard = skeleton, None
        self.stack: list[Node] = []
        self.out: list[dict] = []

    def row(self, shard: int, key: bytes, conv_id: int, sizes: list[int], ends: bool, low: int | None,
            below: Below | None) -> None:
        stack = self.stack
        keep = 0
        if stack and shard == self.shard and stack[0].key == key[:ROOT_BYTES]:
            last, keep = stack[-1].key, 1
            while keep < len(stack) and keep <= len(sizes):
                a = ROOT_BYTES + (keep - 1) * TURN_BYTES
                if last[a : a + TURN_BYTES] != key[a : a + TURN_BYTES]:
                    break
                keep += 1
        while len(stack) > keep:
            self.pop()
        self.shard = shard
        for i in range(keep, len(sizes) + 1):
            own = key[: ROOT_BYTES + i * TURN_BYTES]
            stack.append(Node(own, sizes[i - 1] if i else 0, own in self.skeleton))
            if not i and low is not None:
                stack[0].low = low
        top = stack[-1]
        top.n += 1
        top.low = conv_id if top.low is None else min(top.low, conv_id)
        if below is not None:
            top.below = below
        if ends:
            self.end(top, conv_id)

    def end(self, node: Node, conv_id: int) -> None:
        if node.skeleton:
            node.ids.append(str(conv_id))
            node.held += len(node.ids[-1]) + 1
            if node.held >= CHUNK_BYTES:
                self.flush(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv_id).encode())
        else:
            node.ends.update(b",%d" % conv_id)

    def flush(self, node: Node) -> None:
        if node.ids:
            self.out.append({"kind": ENDS, "key": node.key, "shard": self.shard, "at": node.flushed,
                             "ids": ",".join(node.ids)})
            node.ids, node.held, node.flushed = [], 0, node.flushed + 1

    def pop(self) -> None:
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        segment = int.from_bytes(node.key[:8], "big")
        depth = segment * SEGMENT + (len(node.key) - ROOT_BYTES) // TURN_BYTES
        if parent is not None:
            parent.n += node.n
            parent.low = node.low if parent.low is None else min(parent.low, node.low)
        children, leaves, saved = node.children, node.leaves, node.saved
        if node.below is not None:
            children, leaves, saved = (a + b for a, b in zip((children, leaves, saved), node.below))
        record = {
            "kind": PARTIAL if node.skeleton else FINISHED, "key": node.key, "conv_id": node.low, "depth": depth,
            "n_convs": node.n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "size": node.size,
        }
        if node.skeleton:
            self.flush(node)
            # What comes from below is the same in every shard: it is reduced by maximum, not by sum.
            if node.below is not None:
                record |= {"n_children": node.children, "n_leaves": node.leaves, "saved_tokens": node.saved,
                           "ids": ",".join(map(str, node.below))}
            self.out.append(record)
            return
        record["n_leaves"] = leaves = leaves if children else 1
        record["saved_tokens"] = saved = saved + (node.n - 1) * node.size
        record["ends_sha256"] = NOTHING if node.ends is None else node.ends.hexdigest()
        for child in node.pending:
            child["parent_conv_id"] = node.low
        self.out += node.pending
        if parent is None:
            if segment:
                record["kind"] = ROOT
            self.out.append(record)
            return
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        del record["key"]
        if parent.skeleton:
            record["parent"] = parent.key
            self.out.append(record)
        else:
            parent.pending.append(record)

    def close(self) -> None:
        while self.stack:
            self.pop()

    def records(self, least: int) -> Iterator[pa.RecordBatch]:
        while self.out and len(self.out) >= least:
            some, self.out = self.out[:BATCH_RECORDS], self.out[BATCH_RECORDS:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(name) for r in some], kind) for name, kind in zip(NAMES, TYPES)], NAMES)


def beginnings(splitters: list[tuple[bytes, int]]) -> frozenset[bytes]:
    """The skeleton: every beginning of every splitter's path, its root included."""
    return frozenset(
        key[:end] for key, _ in splitters for end in range(ROOT_BYTES, len(key) + 1, TURN_BYTES))


def walk_batches(batches: Iterator[pa.RecordBatch], splitters) -> Iterator[pa.RecordBatch]:
    walk = Walk(beginnings(splitters.value))
    for batch in batches:
        for r in batch.to_pylist():
            below = None if r["b_children"] is None else Below(r["b_children"], r["b_leaves"], r["b_saved"])
            walk.row(r["shard"], r["key"], r["conv_id"], r["sizes"], r["ends"], r["low"], below)
            if len(walk.out) >= BATCH_RECORDS:
                yield from walk.records(BATCH_RECORDS)
    walk.close()
    yield from walk.records(1)


def deal_batches(batches: Iterator[pa.RecordBatch], splitters) -> Iterator[pa.RecordBatch]:
    cuts = splitters.value
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        shards = [bisect.bisect_right(cuts, own) for own in zip(keys, ids)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int32())], [*batch.schema.names, "shard"])


def walked(rows: DataFrame, folder: str, shards: int) -> tuple[DataFrame, DataFrame]:
    """Records of all shards, written, and the reduced skeleton, written.

    rows: conv_id, key, sizes, ends, low, b_children, b_leaves, b_saved.
    """
    spark = rows.sparkSession
    sample = rows.select("key", "conv_id").orderBy(F.xxhash64("key", "conv_id")).limit(shards * SAMPLES_PER_SHARD)
    drawn = sorted((bytes(r.key), r.conv_id) for r in sample.collect())
    step = max(1, -(-len(drawn) // shards))
    splitters = spark.sparkContext.broadcast(drawn[step::step])
    partitions = max(1, shards // SHARDS_PER_PARTITION)
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", shard int"
    sorted_shards = (
        rows.mapInArrow(lambda it: deal_batches(it, splitters), schema)
        .repartition(partitions, "shard").sortWithinPartitions("shard", "key", "conv_id")
    )
    records = written(sorted_shards.mapInArrow(lambda it: walk_batches(it, splitters), RECORDS), f"{folder}/records")
    return records, written(skeleton(records), f"{folder}/skeleton")


def skeleton(records: DataFrame) -> DataFrame:
    """Skeleton nodes (key, conv_id, depth, n_convs, n_children, n_leaves, saved_tokens) from the partials."""
    parts = records.where(F.col("kind") == PARTIAL)
    below = F.split("ids", ",")
    nodes = parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("size").alias("size"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        *[F.coalesce(F.max(F.get(below, F.lit(i)).cast("long")), F.lit(0)).alias(f"b{i}") for i in range(3)],
    )
    inner = F.length("key") > ROOT_BYTES
    above = F.substring("key", F.lit(1), F.length("key") - TURN_BYTES)
    counted = nodes.where(inner).groupBy(above.alias("key")).agg(F.count(F.lit(1)).alias("in_skeleton"))
    nodes = nodes.join(counted, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("in_skeleton", F.lit(0)) + F.col("b0"))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    ends = F.sequence(F.lit(ROOT_BYTES), F.length("key"), F.lit(TURN_BYTES))
    sums = nodes.select(
        F.explode(F.transform(ends, lambda e: F.substring("key", F.lit(1), e))).alias("key"),
        (F.col("n_leaves") + F.col("b1") + leaf).alias("leaves"),
        (F.col("saved_tokens") + F.col("b2") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    ).groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return nodes.drop("n_leaves", "saved_tokens").join(sums, "key").select(
        "key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.when(inner, above).alias("parent"))


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each key, of its ids in the order they come."""
    key = digest = None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if own == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((key, digest.hexdigest()))
            key, digest = own, hashlib.sha256(ids.encode())
        yield _digests(done)
    if key is not None:
        yield _digests([(key, digest.hexdigest())])


def _digests(done: list[tuple]) -> pa.RecordBatch:
    keys, texts = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["key", "ends_sha256"])


def skeleton_ends(records: DataFrame) -> DataFrame:
    """ends_sha256 of the skeleton nodes where conversations end. Ids come in chunks, are streamed
    in their order and never held together."""
    chunks = records.where(F.col("kind") == ENDS).select("key", "shard", "at", "ids")
    ordered = chunks.repartition("key").sortWithinPartitions("key", "shard", "at")
    return ordered.mapInArrow(digest_batches, "key binary, ends_sha256 string")


def sums_below(rows: DataFrame, folder: str, shards: int) -> tuple[DataFrame, DataFrame] | None:
    """For conversations of more than one segment: (root, low) and (root, b_children, b_leaves, b_saved).

    low is the smallest member of the node that the segments go on from; the sums cover everything
    below it. None where no conversation is that long.
    """
    later = rows.where("segment > 0")
    deepest = later.agg(F.max("segment")).first()[0]
    if deepest is None:
        return None
    own_root = F.substring("key", 1, ROOT_BYTES)
    roots = written(
        rows.where("next is not null").groupBy(F.col("next").alias("root")).agg(
            F.min("conv_id").alias("low"), F.min(own_root).alias("above")),
        f"{folder}/roots")
    # A full segment that goes on has something below it, so it is no leaf; its sums come later.
    goes_on = F.when(F.col("next").isNotNull() & ~F.col("ends"), F.lit(0).cast("long"))
    first = later.select(
        "conv_id", "key", "sizes", "ends", F.lit(None).cast("long").alias("low"),
        (goes_on + 1).alias("b_children"), goes_on.alias("b_leaves"), goes_on.alias("b_saved"))
    records, bones = walked(first, f"{folder}/later", shards)
    columns = ["key", "n_children", "n_leaves", "saved_tokens"]
    found = records.where(F.col("kind") == ROOT).select(columns).unionByName(
        bones.where(F.length("key") == ROOT_BYTES).select(columns))
    sums = found.withColumnRenamed("key", "root").join(roots, "root").select(
        "root", "n_children", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"),
        F.col("above").alias("far"))
    for step in range(int(deepest).bit_length()):
        sums = written(sums, f"{folder}/sums-{step}")
        up = sums.groupBy(F.col("far").alias("root")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        far = sums.select(F.col("root").alias("far"), F.col("far").alias("farther"))
        sums = sums.join(up, "root", "left").join(far, "far", "left").select(
            "root", "n_children", *[
                (F.col(a) + F.coalesce(F.col(b), F.lit(0).cast("long"))).alias(a) for a, b in (("leaves", "l"), ("saved", "s"))],
            F.col("farther").alias("far"))
    sums = sums.select("root", F.col("n_children").alias("b_children"), F.col("leaves").alias("b_leaves"),
                       F.col("saved").alias("b_saved"))
    return roots.select("root", "low"), written(sums, f"{folder}/sums")


def trie_nodes(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of rebuilt conversations (conv_id, turn, role, text).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Broadcast are the splitters: one path of at most SEGMENT turns for each shard, of which there
    are SHARDS_PER_PARTITION for each shuffle partition unless shards says otherwise.

    Defined cases: turns come by number, NULL first, and by a hash of role and text where numbers
    are equal; repeated rows are turns each. NULL role and text are empty. Rows without conv_id
    belong to no conversation. The remainder of a negative conv_id is negative, as in SQL. No
    conversations give no nodes, not even a root. Other columns are not read.
    """
    spark = conversations.sparkSession
    folder = scratch(spark, "trie")
    if shards is None:
        shards = SHARDS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = paths(rebuilt(turns(conversations, folder), folder), folder)
    none = F.lit(None).cast("long")
    columns = ["conv_id", "key", "sizes", "ends", "low", "b_children", "b_leaves", "b_saved"]
    long = sums_below(rows, folder, shards)
    if long is None:
        ready = rows.withColumns(dict.fromkeys(columns[4:], none))
    else:
        lows, sums = long
        known = rows.withColumn("root", F.substring("key", 1, ROOT_BYTES))
        early = known.where("segment = 0").withColumn("low", none)
        known = early.unionByName(known.where("segment > 0").join(lows, "root", "left"), allowMissingColumns=True)
        sums = sums.withColumnRenamed("root", "next")
        full = known.where("next is not null").join(sums, "next", "left")
        ready = full.unionByName(known.where("next is null"), allowMissingColumns=True)
    records, bones = walked(ready.select(columns), f"{folder}/all", shards)
    lows = F.broadcast(bones.select(F.col("key").alias("parent"), F.col("conv_id").alias("above")))
    measures = ["conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs",
                "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    finished = records.where(F.col("kind") == FINISHED).join(lows, "parent", "left").select(measures)
    is_node = (F.length("key") > ROOT_BYTES) | (F.col("depth") == 0)
    bones = bones.where(is_node).join(skeleton_ends(records), "key", "left").join(lows, "parent", "left")
    bones = bones.withColumns({
        "ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING)), "parent_conv_id": none})
    return reduce(DataFrame.unionByName, [finished, bones.select(measures)])
